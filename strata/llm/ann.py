"""Approximate nearest neighbours by cross-polytope hashing (operator 3).

Unit vectors pass a pseudo-rotation - three rounds of random signs and a fast
Hadamard transform - and fall to the nearest signed axis. Two rotations make a
table, whose cells are pairs of axes (a bucket and a place in it); a vector lies
in one cell of each of ``TABLES`` tables. A query looks into the cells that its
neighbours most likely fell into: those for which the squared distances of its
coordinates to its largest ones add up to least. What it finds is reranked by the
inner product of the original vectors in double precision. Vectors of different
lengths get one more coordinate first, which makes the largest inner product the
nearest unit vector.

How many cells a query probes is fitted, for each dimension, on a sample of
``SAMPLE`` queries at most: these are compared with every row, and the least number
is taken with which ``TARGET`` of their nearest would be found. So the share of the
table that a query is compared with falls as the table grows or its vectors cluster.

Equal vectors are one class with its smallest ids, so a vector that holds a
third of the table is hashed and compared once. A bucket's classes are packed
into matrices of bounded size, and so are the queries that probe it; matrices
meet in a join, and of a pair of them only the rows of common cells are compared.
A query that finds fewer rows than asked for is compared with every class, dealt
over as many tasks as the table asks for; only if there is such a query.

Vectors of different dimensions are searched side by side, each dimension among
itself. Vectors that are null, zero, or hold null or non-finite components take
no part, nor do rows without an id. An
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

#: Tables, of two rotations each.
TABLES = 16
#: Axes of a rotation among which a query chooses its cells.
AXES = 64
#: Queries on which the number of probes is fitted, and the share of their nearest
#: that it is to find.
SAMPLE, TARGET = 64, 0.96
#: Classes or queries in a matrix.
PACK = 512
#: Found rows that a task holds before it keeps the best of them.
HELD = 1 << 18
SEED = 20


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row."""
    n, half = x.shape[1], 1
    while half < n:
        x = x.reshape(-1, n // (2 * half), 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(-1, n)
        half *= 2
    return x / math.sqrt(n)


def rotated(x: np.ndarray, table: int) -> np.ndarray:
    """Rows of ``x``, filled up to a power of two, under the table's rotation."""
    n = 1 << max(0, (x.shape[1] - 1).bit_length())
    if n > x.shape[1]:
        x = np.concatenate([x, np.zeros((len(x), n - x.shape[1]))], axis=1)
    for signs in np.random.default_rng([SEED, table]).choice([-1.0, 1.0], (3, n)):
        x = hadamard(x * signs)
    return x


def signed(x: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
    """The coordinates of each row along the signed axes of the table's rotations."""
    return tuple(np.concatenate([y, -y], axis=1) for y in (rotated(x, 2 * table), rotated(x, 2 * table + 1)))


def cell(x: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest signed axes of each row."""
    return tuple(s.argmax(axis=1) for s in signed(x, table))


def cells(x: np.ndarray, table: int, probes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``probes`` likeliest cells of each row, as two arrays of axes, and their costs."""
    near, costs = [], []
    for s in signed(x, table):
        n = min(AXES, s.shape[1])
        best = np.argpartition(-s, n - 1, axis=1)[:, :n]
        near.append(best)
        value = np.take_along_axis(s, best, 1)
        costs.append(np.square(value.max(axis=1, keepdims=True) - value))
    cost = (costs[0][:, :, None] + costs[1][:, None, :]).reshape(len(x), -1)
    n, wide = min(probes, cost.shape[1]), near[1].shape[1]
    best = np.argpartition(cost, n - 1, axis=1)[:, :n]
    return (np.take_along_axis(near[0], best // wide, 1), np.take_along_axis(near[1], best % wide, 1),
            np.take_along_axis(cost, best, 1))


def fitted_probes(queries: np.ndarray, near: list[np.ndarray], target: float = TARGET) -> int:
    """The least number of probes with which ``target`` of the vectors ``near`` each
    of the ``queries`` fall into a probed cell of some table."""
    ranks = [np.full(len(n), np.inf) for n in near]
    for table in range(TABLES):
        one, two, cost = cells(queries, table, AXES * AXES)
        for i, vectors in enumerate(near):
            a, b = cell(vectors, table)
            order = np.argsort(cost[i], kind="stable")
            place = np.full((max(one[i].max(), a.max()) + 1, max(two[i].max(), b.max()) + 1), np.inf)
            place[one[i][order], two[i][order]] = np.arange(len(order))
            ranks[i] = np.minimum(ranks[i], place[a, b])
    ranks = np.sort(np.concatenate(ranks)) if ranks else np.empty(0)
    if not len(ranks):
        return 1
    needed = ranks[min(len(ranks) - 1, math.ceil(target * len(ranks)) - 1)]
    return int(min(needed, AXES * AXES - 1)) + 1


def valid(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    fine = (F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & (F.size(v) > 0)
            & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(v, lambda x: x != 0))
    # -0.0 and 0.0 are the same component; single precision stays single
    kind = "array<float>" if dict(df.dtypes)[vector_col] == "array<float>" else "array<double>"
    return df.where(F.coalesce(fine, F.lit(False))).select(
        F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: x + F.lit(0.0)).cast(kind).alias("v"))


def classes(rows: DataFrame, members: int) -> DataFrame:
    """(cls, v, ids): classes of equal vectors, each named after its smallest id,
    with up to ``members`` smallest ids. ``rows``: id, v."""
    key = ["k1", "k2"]
    ranked = (rows.withColumn("k1", F.xxhash64("v")).withColumn("k2", F.xxhash64(F.lit(1), "v"))
              .withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy("id")))
              .where(F.col("rank") <= members))  # kept in part before the shuffle
    return ranked.groupBy(*key).agg(F.min("id").alias("cls"), F.min_by("v", "id").alias("v"),
                                    F.array_sort(F.collect_set("id")).alias("ids"))


def matrix(column: pa.Array) -> np.ndarray:
    """Equally long lists as rows."""
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def units(x: np.ndarray, longest: float | None) -> np.ndarray:
    """Rows as unit vectors. With ``longest`` they are scaled by it instead and
    get the coordinate that completes them; a query (``longest`` 0) gets a zero."""
    if longest is None:
        return x / np.linalg.norm(x, axis=1, keepdims=True)
    if longest == 0:
        return np.concatenate([units(x, None), np.zeros((len(x), 1))], axis=1)
    x = x / longest
    rest = np.sqrt(np.maximum(0, 1 - np.square(x).sum(axis=1, keepdims=True)))
    return np.concatenate([x, rest], axis=1)


def by_dimension(batch: pa.RecordBatch, column: str = "v"):
    """The dimensions in a batch, each with the places of its rows."""
    sizes = pa.compute.list_value_length(batch.column(column)).to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes).tolist():
        yield dim, np.flatnonzero(sizes == dim)


def hashed(rows: DataFrame, id_col: str, longest: dict[int, float], probes: dict[int, int] | None = None) -> DataFrame:
    """(dim, tab, bucket, id, v, places): the cell of each row in each table, or with
    ``probes`` the cells that it probes, those of a bucket together. ``rows``: id_col,
    v. ``longest`` and ``probes``: by dimension, see ``units``."""
    def assign(batches):
        for batch in batches:
            for dim, at_dim in by_dimension(batch):
                for at in range(0, len(at_dim), 1024):
                    part = batch.take(pa.array(at_dim[at:at + 1024]))
                    u = units(matrix(part.column("v")), longest.get(dim))
                    for table in range(TABLES):
                        if probes is None:
                            bucket, place = (x.reshape(-1, 1) for x in cell(u, table))
                        else:
                            bucket, place, _ = cells(u, table, probes.get(dim, 1))
                        row = np.repeat(np.arange(len(u)), bucket.shape[1])
                        order = np.lexsort((bucket.ravel(), row))
                        row, bucket, place = row[order], bucket.ravel()[order], place.ravel()[order]
                        first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (bucket[1:] != bucket[:-1])))
                        yield pa.RecordBatch.from_pydict({
                            "dim": pa.array(np.full(len(first), dim, np.int32)),
                            "tab": pa.array(np.full(len(first), table, np.int32)),
                            "bucket": pa.array(bucket[first].astype(np.int32)),
                            "id": part.column(id_col).take(pa.array(row[first])),
                            "v": part.column("v").take(pa.array(row[first])),
                            "places": pa.ListArray.from_arrays(pa.array(np.append(first, len(row)).astype(np.int32)),
                                                               pa.array(place.astype(np.int32)))})

    kind = rows.schema["v"].dataType.simpleString()
    return rows.select(id_col, "v").mapInArrow(
        assign, f"dim int, tab int, bucket int, id long, v {kind}, places array<int>")


def packs(rows: DataFrame, keys: list[str], spread: int) -> DataFrame:
    """Rows of equal ``keys`` (the dimension among them) in matrices of at most
    ``PACK``: (keys, ids, m, places, sizes), with each row's places one after the other
    and their number."""
    kind = "<f4" if rows.schema["v"].dataType.simpleString() == "array<float>" else "<f8"

    def gather(batches):
        key, ids, parts, places, sizes, held = None, [], [], [], [], 0

        def flush():
            yield pa.RecordBatch.from_pydict({
                **{k: pa.array([x], pa.int32()) for k, x in zip(keys, key)},
                "ids": pa.array([np.concatenate(ids).astype("<i8").tobytes()], pa.binary()),
                "m": pa.array([np.concatenate(parts).astype(kind).tobytes()], pa.binary()),
                "places": pa.array([np.concatenate(places).astype("<i4").tobytes()], pa.binary()),
                "sizes": pa.array([np.concatenate(sizes).astype("<i4").tobytes()], pa.binary())})

        for batch in batches:
            columns = np.stack([batch.column(k).to_numpy() for k in keys], axis=1)
            cuts = [0, *(np.flatnonzero((columns[1:] != columns[:-1]).any(axis=1)) + 1), batch.num_rows]
            all_ids, listed = batch.column("id").to_numpy(), batch.column("places")
            counts, ends = np.diff(listed.offsets.to_numpy()), listed.offsets.to_numpy()
            flat = listed.values.to_numpy()
            for start, end in zip(cuts, cuts[1:]):
                first, run = start, matrix(batch.column("v").slice(start, end - start))  # of one dimension
                mine = tuple(columns[start].tolist())
                if held and mine != key:
                    yield from flush()
                    ids, parts, places, sizes, held = [], [], [], [], 0
                key = mine
                while start < end:
                    upto = min(end, start + PACK - held)
                    ids.append(all_ids[start:upto])
                    parts.append(run[start - first:upto - first])
                    places.append(flat[ends[start]:ends[upto]])
                    sizes.append(counts[start:upto])
                    held += upto - start
                    start = upto
                    if held == PACK:
                        yield from flush()
                        ids, parts, places, sizes, held = [], [], [], [], 0
        if held:
            yield from flush()

    # a hot bucket goes to several tasks
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(spread)))
    ordered = dealt.repartition(*keys, "salt").sortWithinPartitions(*keys, "salt", "id").drop("salt")
    return ordered.mapInArrow(gather, ", ".join(f"{k} int" for k in keys) + ", " + PACKED)


PACKED = "ids binary, m binary, places binary, sizes binary"
SIDES = ["ids", "m", "places", "sizes"]


def common(q_places: np.ndarray, q_sizes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) of the pairs of a query and a row in one of its places. A row
    has one place, a query each of its places once, so no pair comes twice."""
    order = np.argsort(places, kind="stable")
    there = places[order]
    low, high = np.searchsorted(there, q_places), np.searchsorted(there, q_places, "right")
    n = high - low
    row = order[np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    return np.repeat(np.repeat(np.arange(len(q_sizes)), q_sizes), n), row


def top(query: np.ndarray, cls: np.ndarray, score: np.ndarray, keep: int) -> tuple[np.ndarray, ...]:
    """The ``keep`` best classes of each query, each class once."""
    order = np.lexsort((-score, cls, query))
    query, cls, score = query[order], cls[order], score[order]
    once = np.concatenate([[True], (query[1:] != query[:-1]) | (cls[1:] != cls[:-1])])
    query, cls, score = query[once], cls[once], score[once]
    order = np.lexsort((cls, -score, query))
    query, cls, score = query[order], cls[order], score[order]
    begins = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]]))
    place = np.arange(len(query)) - np.repeat(begins, np.diff([*begins, len(query)]))
    return query[place < keep], cls[place < keep], score[place < keep]


def met(asked: DataFrame, held: DataFrame, keys: list[str]) -> DataFrame:
    """Matrices of queries and of classes with equal ``keys``. Merged, for a plan that
    goes by the types takes a matrix for a hundred bytes: none is broadcast."""
    return asked.hint("merge").join(held, keys)


def products(pairs: DataFrame, keep: int, kind: str, every: bool = False) -> DataFrame:
    """(query, cls, score): the ``keep`` best of each query in the pairs of
    matrices of a task, up to ``HELD`` rows at a time. Of a pair the rows of common
    places are compared, or with ``every`` all. ``pairs``: ``SIDES`` of the queries
    (q_...) and the classes."""
    def scored(q_m, m, q_places, q_sizes, places):
        if every:
            scores = q_m @ m.T
            n = min(keep, len(m))
            near = np.argpartition(-scores, n - 1, axis=1)[:, :n]
            yield np.repeat(np.arange(len(q_m)), n), near.ravel(), np.take_along_axis(scores, near, 1).ravel()
            return
        query, row = common(q_places, q_sizes, places)
        if len(query) > len(q_m) * len(m) / 8:
            yield query, row, (q_m @ m.T)[query, row]
            return
        for at in range(0, len(query), 1 << 16):
            q, r = query[at:at + (1 << 16)], row[at:at + (1 << 16)]
            yield q, r, np.einsum("ij,ij->i", q_m[q], m[r])

    def multiply(batches):
        held, n_held = [], 0
        # queries that have enough, and the score to reach
        full, least = np.empty(0, np.int64), np.empty(0)

        def best():
            return top(*(np.concatenate(x) for x in zip(*held)), keep)

        def bounds(query, _, score):
            last = np.flatnonzero(np.append(query[1:] != query[:-1], True))
            enough = np.diff(last, prepend=-1) >= keep
            return query[last[enough]], score[last[enough]]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(x) for x in rows], names=["query", "cls", "score"])

        columns = ["q_" + c for c in SIDES] + SIDES
        for batch in batches:
            for row in zip(*(batch.column(c) for c in columns)):
                q_ids, q_m, q_places, q_sizes, ids, m, places, _ = (x.as_buffer() for x in row)
                q_ids, ids = np.frombuffer(q_ids, "<i8"), np.frombuffer(ids, "<i8")
                q_m, m = (np.frombuffer(x, kind).astype(np.float64).reshape(len(n), -1)
                          for x, n in ((q_m, q_ids), (m, ids)))
                bound = np.full(len(q_ids), -np.inf)
                if len(full):
                    at = np.minimum(np.searchsorted(full, q_ids), len(full) - 1)
                    bound = np.where(full[at] == q_ids, least[at], bound)
                for q, r, score in scored(q_m, m, *(np.frombuffer(x, "<i4") for x in (q_places, q_sizes, places))):
                    good = score >= bound[q]
                    held.append((q_ids[q[good]], ids[r[good]], score[good]))
                    n_held += int(good.sum())
                if n_held > HELD:
                    held = [best()]
                    n_held = len(held[0][0])
                    full, least = bounds(*held[0])
                    if n_held > HELD // 2:
                        yield batch_of(held[0])
                        held, n_held = [], 0
        if n_held:
            yield batch_of(best())

    return pairs.select(*["q_" + c for c in SIDES], *SIDES).mapInArrow(multiply, "query long, cls long, score double")


def with_every(queries: DataFrame, index: DataFrame, rows: int, keep: int, kind: str) -> DataFrame:
    """(query, cls, score) of ``queries`` (dim, id, v) with all classes of their
    dimension, in blocks: the classes' matrices are dealt over parts, each of which
    gets all matrices of queries."""
    parts = max(1, min(10_000, rows // (64 * PACK)))
    none = F.array().cast("array<int>")
    block = lambda df: packs(df.withColumn("places", none), ["dim"], max(2, parts))
    asked = block(queries).toDF("dim", *["q_" + c for c in SIDES]).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    held = block(index).withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(parts)).cast("int"))
    return products(met(asked, held, ["dim", "part"]), keep, kind, every=True)


def fit(sample: DataFrame, index: DataFrame, rows: int, k: int, kind: str, longest: dict[int, float]) -> dict[int, int]:
    """The number of probes of each dimension, from the ``sample`` queries (query, v)."""
    dim = F.size("v").alias("dim")
    best = best_of(with_every(sample.select(dim, F.col("query").alias("id"), "v"),
                              index.select(dim, F.col("cls").alias("id"), "v"), rows, k, kind), k)
    # the sample's queries with their k nearest: bounded, so they may come to the driver
    found = (best.join(sample.withColumnRenamed("v", "q_v"), "query").join(index.select("cls", "v"), "cls")
             .select("query", "q_v", "v").collect())
    probes: dict[int, int] = {}
    by_dim: dict[int, dict] = {}
    for r in found:
        by_dim.setdefault(len(r["q_v"]), {}).setdefault(r["query"], (r["q_v"], []))[1].append(r["v"])
    for n, queries in by_dim.items():
        span = longest.get(n)
        probes[n] = fitted_probes(units(np.array([q for q, _ in queries.values()]), None if span is None else 0),
                                  [units(np.array(v), span) for _, v in queries.values()])
    return probes


def best_of(found: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` best classes of each query, found in one table or several."""
    once = found.groupBy("query", "cls").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "cls")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep).select("query", "cls")


def exact(pairs: DataFrame) -> DataFrame:
    """``pairs`` (q_v, v, ...) with the inner product, summed the same way always."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import DoubleType, StructField, StructType
    kept = [f for f in pairs.schema.fields if f.name not in ("q_v", "v")]
    schema = StructType([*kept, StructField("score", DoubleType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                score = np.empty(batch.num_rows)
                for _, places in by_dimension(batch):
                    part = batch.select(["q_v", "v"]).take(pa.array(places))
                    score[places] = (matrix(part.column("q_v")) * matrix(part.column("v"))).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(f.name).cast(arrow.field(f.name).type) for f in kept), pa.array(score)], schema=arrow)

    return pairs.mapInArrow(run, schema)


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, probes: dict[int, int] | None = None,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id_col, score): the ``k`` nearest rows of ``vectors`` that
    each row of ``queries`` finds, itself (the row of its id) left out. ``probes``, by
    dimension, are fitted unless given."""
    rows, asked = valid(vectors, id_col, vector_col), valid(queries, id_col, vector_col)
    dim = F.size("v").alias("dim")
    sizes = C.cut(rows.groupBy(dim).agg(F.count("*").alias("rows")), "ann_sizes")
    index = C.cut(classes(rows, k + 1), "ann_classes")
    # queries of one vector share their search: the class is named after any of them
    asked = asked.withColumn("k1", F.xxhash64("v")).withColumn("k2", F.xxhash64(F.lit(1), "v"))
    names = asked.groupBy("k1", "k2").agg(F.min("id").alias("query"))
    vectors_asked = C.cut(asked.join(names, ["k1", "k2"]).where("id = query").select("query", "v")
                          .dropDuplicates(["query"]), "ann_queries")
    asked = C.cut(asked.join(names, ["k1", "k2"]).select(F.col("id").alias("query_id"), "query").distinct(), "ann_asked")

    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    spans = index.groupBy(dim).agg(F.min(norm).alias("low"), F.max(norm).alias("high")).collect()  # a row per dimension
    longest = {r["dim"]: r["high"] for r in spans if r["high"] - r["low"] > 1e-6 * r["high"]}
    keep = k + 4  # room for products that differ in the last bit
    kind = "<f4" if rows.schema["v"].dataType.simpleString() == "array<float>" else "<f8"
    n_rows = index.count()
    if probes is None:
        sample = vectors_asked.orderBy(F.xxhash64("query")).limit(SAMPLE)
        probes = fit(C.cut(sample, "ann_sample"), index, n_rows, k + 1, kind, longest)
    # a hot bucket is dealt over several tasks
    buckets, spread = ["dim", "tab", "bucket"], max(2, n_rows // 200_000)
    held = packs(hashed(index, "cls", longest), buckets, spread)
    wanted = packs(hashed(vectors_asked, "query", dict.fromkeys(longest, 0), probes), buckets, 2)
    found = products(met(wanted.toDF(*buckets, *["q_" + c for c in SIDES]), held, buckets), keep, kind)
    best = C.cut(best_of(found, keep), "ann_best")

    # who found less than there is to find asks every class
    members = index.select("cls", F.size("ids").alias("n"))
    enough = (best.join(members, "cls").groupBy("query").agg(F.sum("n").alias("n"))
              .join(vectors_asked.select("query", dim), "query").join(sizes, "dim")
              .where(F.col("n") >= F.least(F.lit(k + 1), "rows")).select("query"))
    poor = C.cut(vectors_asked.join(enough, "query", "left_anti"), "ann_poor")
    if not poor.isEmpty():
        rest = with_every(poor.select(dim, F.col("query").alias("id"), "v"),
                          index.select(dim, F.col("cls").alias("id"), "v"), n_rows, keep, kind)
        best = C.cut(best.join(poor.select("query"), "query", "left_anti").unionAll(best_of(rest, keep)), "ann_best")

    scored = exact(best.join(vectors_asked.withColumnRenamed("v", "q_v"), "query").join(index.select("cls", "v", "ids"), "cls"))
    # the rows of a query's best classes: at most (k + 1) of each of k + 4
    nearest = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    listed = (scored.select("query", "score", F.explode("ids").alias("id"))
              .withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k + 1).drop("rank"))
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (asked.join(listed, "query").where("id != query_id")
            .withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))


def op3_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = C.table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where(F.col("vec_id") % 20 == 0))
