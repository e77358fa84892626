"""Near-duplicates by an LSH forest over MinHash signatures (operator 9).

Texts are reduced to classes of equal word sequences first, so thousands of
copies cost one signature. A class's signature is cut into several labels, one
for each tree of the forest; a tree is the classes sorted by label. Two classes
are candidates where their labels share a prefix of ``MIN_DEPTH`` hashes or
more, the candidates of a class being its neighbours in the sorted order, those
with the longest common prefix. Where a region of a tree is crowded, its depth
grows hash by hash until its parts are small or the label ends.

Candidates are confirmed on the full shingle sets, in rounds. A round takes
each class's best neighbour of another component, which joins a large group of
near copies along its sorted orders without listing its pairs. A last one takes
every region that still holds two components: the pairs of a small one are
listed, the classes of a larger one are compared block by block in matrices,
which tell only links that connect components. So no link between components
that share a region is missed, and no group's pairs are ever listed.
Components are found by stars on the links of all rounds.

A text without words, or a null one, has no shingles and links with nothing; a
row without an id is never linked and always kept; rows that repeat an id and
a text are one document and fare alike; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

#: Words of a shingle.
SHINGLE = 5
#: Linked are sets whose intersection has this share of the union, in percent.
PERCENT = 85
#: Trees, and hashes of a label. Two sets at the threshold share a prefix of
#: ``MIN_DEPTH`` hashes in at least one tree with probability 1 - 6e-5.
TREES = 16
DEPTH = 8
MIN_DEPTH = 5
#: Classes of a region up to which its pairs are listed, and beyond which its
#: depth grows; between, and where labels end, they are compared in blocks.
FEW = 6
CROWD = 512
#: Classes, and bytes of their shingle sets, in a block.
BLOCK = 128
BLOCK_BYTES = 8 << 20
#: Classes of a region's part.
PART = 256
#: Rounds of best neighbours before the last one over all pairs left.
ROUNDS = 1
#: A pair whose signatures agree in a smaller share than this is not confirmed:
#: five standard deviations below the threshold for 128 hashes.
SCREEN = 0.69

PRIME = np.uint64(0x9E3779B97F4A7C15)
SIGNATURE = "doc_id long, h1 long, h2 long, n_shingles long, signature binary"


def _mix(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and offsets of ``n`` hash functions, the same everywhere."""
    base = _mix((np.arange(1, 2 * n + 1, dtype=np.uint64)) * PRIME)
    return base[:n] | np.uint64(1), base[n:]


def words_of(raw: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words between ASCII white space."""
    return raw.lower().split()


class Shingles:
    """64-bit hashes of a text's distinct shingles; remembers word hashes."""

    MEMORY = 400_000

    def __init__(self, size: int = SHINGLE):
        self.size, self.seen = size, {}
        self.factors = _mix(np.arange(11, 11 + size, dtype=np.uint64) * PRIME) | np.uint64(1)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.empty(0, np.uint64)
        seen = self.seen
        if len(seen) > self.MEMORY:
            seen.clear()
        for w in words:
            if w not in seen:
                seen[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))
        n = max(1, len(h) - self.size + 1)
        total = np.full(n, len(h[:self.size]), np.uint64)
        for k, factor in enumerate(self.factors[:len(h)]):
            total = total + h[k:k + n] * factor
        return np.unique(_mix(total))


def signature_of(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least upper half of each hash function over the set."""
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(shingles), 4096):  # a long text a stretch at a time
        part = shingles[at:at + 4096, None] * a + b
        out = np.minimum(out, (part >> np.uint64(32)).astype(np.uint32).min(axis=0))
    return out


def signatures(docs: DataFrame, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """Class hashes, size of the shingle set and signature. ``docs``: doc_id, text."""
    def sign(batch):
        a, b = permutations(trees * depth)
        shingles, h1, h2, n, signature = Shingles(), [], [], [], []
        for raw in C.raw_texts(batch):
            words = words_of(raw)
            found = shingles(words)
            digest = xxhash.xxh3_128_digest(b" ".join(words))
            h1.append(int.from_bytes(digest[:8], "little", signed=True))
            h2.append(int.from_bytes(digest[8:], "little", signed=True))
            n.append(len(found))
            signature.append(signature_of(found, a, b).tobytes() if len(found) else None)
        return {"doc_id": batch.column("doc_id"), "h1": h1, "h2": h2, "n_shingles": n, "signature": signature}

    return C.map_batches(docs, sign, SIGNATURE)


def forest(classes: DataFrame, trees: int = TREES, depth: int = DEPTH, min_depth: int = MIN_DEPTH) -> DataFrame:
    """(region, label, doc_id): each class in each tree. ``region`` stands for the
    tree and the first ``min_depth`` hashes, ``label`` for the further ones."""
    def plant(batch):
        raw = batch.column("signature").to_pylist()
        hashes = np.frombuffer(b"".join(raw), np.uint32).reshape(-1, trees, depth)
        regions, labels = [], []
        for row in hashes:
            for tree in range(trees):
                prefix = row[tree, :min_depth].tobytes() + bytes([tree])
                regions.append(xxhash.xxh3_64_intdigest(prefix) - (1 << 63))
                labels.append(row[tree, min_depth:].astype(">u4").tobytes())
        rows = pa.array(np.repeat(np.arange(len(raw)), trees))
        return {"region": regions, "label": labels, "doc_id": batch.column("doc_id").take(rows)}

    return C.map_batches(classes.select("doc_id", "signature"), plant, "region long, label binary, doc_id long")


def rooted(planted: DataFrame, roots: DataFrame) -> DataFrame:
    """``planted`` with the component of each class, in the regions that hold
    classes of several components."""
    rows = (planted.join(roots.select(F.col("node").alias("doc_id"), "root"), "doc_id", "left")
            .withColumn("root", F.coalesce("root", "doc_id")))
    mixed = rows.groupBy("region").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
    return rows.join(mixed.select("region"), "region")


def neighbours(planted: DataFrame) -> DataFrame:
    """(a, b, prefix): each class with the nearest one before it in its region's
    sorted order that is of another component, and how many hashes beyond the
    region's they share, plus one. ``planted`` is rooted."""
    def walk(batches):
        region, last, other = None, None, None  # (label, class, root)
        for batch in batches:
            a, b, shared = [], [], []
            for r, x, d, root in zip(*(batch.column(c).to_pylist() for c in ("region", "label", "doc_id", "root"))):
                if r != region:
                    region, last, other = r, None, None
                if last is not None and last[2] != root:
                    other = last
                if other is not None and other[2] != root:
                    same = next((i for i, (p, q) in enumerate(zip(x, other[0])) if p != q), len(x))
                    a.append(min(d, other[1]))
                    b.append(max(d, other[1]))
                    shared.append(1 + same // 4)
                last = (x, d, root)
            if a:
                yield pa.RecordBatch.from_pydict({"a": a, "b": b, "prefix": pa.array(shared, pa.int32())})

    ordered = planted.repartition("region").sortWithinPartitions("region", "label", "doc_id")
    pairs = ordered.mapInArrow(walk, "a long, b long, prefix int")
    return pairs.groupBy("a", "b").agg(F.sum("prefix").alias("prefix"))


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, shingles) of the ``wanted`` documents, from a second reading of
    the texts: only those that pass a key filter of the ids leave the scan."""
    bitmap = C.key_filter(wanted)

    def collect(batch):
        ok = C.passes(bitmap, batch.column("slot").to_numpy())
        batch = batch.filter(pa.array(ok))
        shingles = Shingles()
        sets = [shingles(words_of(raw)).tobytes() for raw in C.raw_texts(batch)]
        return {"doc_id": batch.column("doc_id"), "shingles": sets}

    found = C.map_batches(docs.select("doc_id", "text", C.slot(F.col("doc_id"), bitmap).alias("slot")), collect,
                          "doc_id long, shingles binary")
    return found.join(wanted, "doc_id", "left_semi").dropDuplicates(["doc_id"])


def screened(pairs: DataFrame, classes: DataFrame, screen: float = SCREEN) -> DataFrame:
    """The ``pairs`` whose signatures agree in a share of at least ``screen``."""
    def agree(batch):
        left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(batch.num_rows, -1)
                       for c in ("sa", "sb"))
        ok = (left == right).mean(axis=1) >= screen
        kept = batch.filter(pa.array(ok))
        return {"a": kept.column("a"), "b": kept.column("b")}

    side = classes.select("doc_id", "signature")
    both = (pairs.join(side.toDF("a", "sa"), "a").join(side.toDF("b", "sb"), "b"))
    return C.map_batches(both, agree, "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The ``pairs`` whose full shingle sets reach the threshold."""
    def compare(batch):
        a, b = [], []
        for x, y, p, q in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "sa", "sb"))):
            p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
            if 100 * min(len(p), len(q)) < percent * max(len(p), len(q)):
                continue
            both = len(np.intersect1d(p, q, assume_unique=True))
            if 100 * both >= percent * (len(p) + len(q) - both):
                a.append(x)
                b.append(y)
        return {"a": a, "b": b}

    both = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    return C.map_batches(both, compare, "a long, b long")


def contracted(links: DataFrame) -> DataFrame:
    """(u, v): the links of each batch as stars around their least nodes, so
    that paths within a batch take no rounds."""
    def run(batches):
        for batch in batches:
            lead: dict[int, int] = {}

            def find(x):
                while (y := lead.get(x, x)) != x:
                    lead[x] = lead.get(y, y)
                    x = y
                return x

            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                x, y = find(a), find(b)
                if x != y:
                    lead[max(x, y)] = min(x, y)
            nodes = list(lead)
            yield pa.RecordBatch.from_pydict({"u": pa.array(nodes, pa.int64()),
                                              "v": pa.array([find(n) for n in nodes], pa.int64())})

    return links.select("a", "b").mapInArrow(run, "u long, v long")


def components(links: DataFrame) -> DataFrame:
    """(node, root): the least node of each node's component, by alternating
    stars: nodes hand their larger neighbours, then their smaller ones, to the
    least node they know, until every edge points at a root."""
    edges = C.cut(contracted(links).where("u != v").distinct(), "star_edges")
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = C.cut(large.where("u != v").distinct(), "star_large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(least.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        small = C.cut(small, "star_small")
        # at rest when a round changes nothing: every node has one edge, to a root
        still = small.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").isEmpty() and small.join(
            small.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()
        edges = small
        if still:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def region_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of classes of different components that share a region. ``rows`` are
    rooted, of regions of a few classes."""
    side = rows.select("region", "doc_id", "root")
    return (side.toDF("region", "a", "ra").join(side.toDF("region", "b", "rb"), "region")
            .where("ra < rb").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def by_depth(rows: DataFrame, depth: int = DEPTH, min_depth: int = MIN_DEPTH, crowd: int = CROWD) -> DataFrame:
    """Rooted ``rows`` in regions as deep as it takes to have ``crowd`` classes
    at most, or as the label goes."""
    out = None
    for extra in range(depth - min_depth + 1):
        if extra:
            deeper = rows.withColumn("region", F.xxhash64("region", F.substring("label", 4 * extra - 3, 4)))
            mixed = deeper.groupBy("region").agg(F.min("root").alias("low"), F.max("root").alias("high"),
                                                 F.count("*").alias("n")).where("low != high")
            rows = C.cut(deeper.drop("n").join(mixed.select("region", "n"), "region"), "forest_deeper")
        here = rows if extra == depth - min_depth else rows.where(F.col("n") <= crowd)
        here = here.select("region", "doc_id", "root", "n")
        out = here if out is None else out.unionAll(here)
        rows = rows.where(F.col("n") > crowd)
    return out


def blocks(rows: DataFrame, part_rows: int = PART) -> DataFrame:
    """The classes of each region in blocks: (region, part, parts, block, ids, roots,
    sizes, sets). ``rows``: region, doc_id, root, n, shingles. A region of many classes
    is dealt over several parts, so that none of its tasks holds all of it."""
    keys = ["region", "part", "parts"]

    def gather(batches):
        key, block, held, size = None, 0, [], 0

        def flush():
            ids, roots, sets = zip(*held)
            yield pa.RecordBatch.from_pydict({
                "region": pa.array([key[0]], pa.int64()), "part": pa.array([key[1]], pa.int32()),
                "parts": pa.array([key[2]], pa.int32()), "block": pa.array([block], pa.int32()),
                "ids": [np.array(ids, "<i8").tobytes()], "roots": [np.array(roots, "<i8").tobytes()],
                "sizes": [np.array([len(x) // 8 for x in sets], "<i8").tobytes()], "sets": [b"".join(sets)]})

        for batch in batches:
            for *own, d, root, x in zip(*(batch.column(c).to_pylist() for c in (*keys, "doc_id", "root", "shingles"))):
                if held and (own != key or len(held) == BLOCK or size + len(x) > BLOCK_BYTES):
                    yield from flush()
                    block, held, size = block + 1 if own == key else 0, [], 0
                key = own
                held.append((d, root, x))
                size += len(x)
        if held:
            yield from flush()

    parts = F.ceil(F.col("n") / part_rows).cast("int")
    dealt = rows.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
    ordered = dealt.repartition("region", "part").sortWithinPartitions("region", "part", "doc_id")
    return ordered.mapInArrow(gather, "region long, part int, parts int, block int, ids binary, roots binary, "
                                      "sizes binary, sets binary")


def common_shingles(sizes1, sets1, sizes2, sets2, columns: int = 8192) -> np.ndarray:
    """How many shingles each set of one block shares with each of another."""
    every, at = np.unique(np.concatenate([sets1, sets2]), return_inverse=True)
    at1, at2 = at[:len(sets1)], at[len(sets1):]
    both = np.zeros(len(every), bool)
    both[at1] = True
    both &= np.isin(np.arange(len(every)), at2)
    place = np.cumsum(both) - 1
    rows1, rows2 = np.repeat(np.arange(len(sizes1)), sizes1), np.repeat(np.arange(len(sizes2)), sizes2)
    rows1, at1 = rows1[both[at1]], place[at1[both[at1]]]
    rows2, at2 = rows2[both[at2]], place[at2[both[at2]]]
    out = np.zeros((len(sizes1), len(sizes2)), np.float32)
    for start in range(0, int(both.sum()), columns):
        sides = []
        for n, rows, cols in ((len(sizes1), rows1, at1), (len(sizes2), rows2, at2)):
            here = (cols >= start) & (cols < start + columns)
            side = np.zeros((n, columns), np.float32)
            side[rows[here], cols[here] - start] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out


def block_links(packed: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links between components found in pairs of blocks of a region: every pair
    of classes is compared on full sets, and enough links come out to connect
    what is linked."""
    def compare(batches):
        for batch in batches:
            a, b = [], []
            for row in batch.to_pylist():
                ids1, roots1, n1 = (np.frombuffer(row[c], "<i8") for c in ("ids", "roots", "sizes"))
                ids2, roots2, n2 = (np.frombuffer(row["o_" + c], "<i8") for c in ("ids", "roots", "sizes"))
                shared = common_shingles(n1, np.frombuffer(row["sets"], np.uint64), n2,
                                         np.frombuffer(row["o_sets"], np.uint64)).astype(np.int64)
                linked = 100 * shared >= percent * (n1[:, None] + n2[None, :] - shared)
                linked &= roots1[:, None] != roots2[None, :]
                lead: dict[int, int] = {}

                def find(x):
                    while (y := lead.get(x, x)) != x:
                        lead[x] = lead.get(y, y)
                        x = y
                    return x

                for i, j in np.argwhere(linked).tolist():
                    x, y = find(int(roots1[i])), find(int(roots2[j]))
                    if x != y:
                        lead[max(x, y)] = min(x, y)
                        a.append(int(ids1[i]))
                        b.append(int(ids2[j]))
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    columns = ["block", "ids", "roots", "sizes", "sets"]
    # a part meets itself and the parts after it, each in a task of its own
    other = packed.select("region", F.col("part").alias("with"), *[F.col(c).alias("o_" + c) for c in columns])
    meets = packed.withColumn("with", F.explode(F.sequence(F.col("part"), F.col("parts") - 1)))
    return (meets.join(other, ["region", "with"]).where("part < with or block <= o_block")
            .select(*columns, *["o_" + c for c in columns]).mapInArrow(compare, "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row of ``docs``.

    A component is named after its smallest id, and that document is kept.
    """
    with C.temporary(docs.sparkSession):
        return C.cut(_near_duplicates(docs, id_col, text_col, percent), "near_duplicates", keep=True)


def _near_duplicates(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = C.cut(signatures(docs), "minhash")
    named = signed.where("doc_id is not null and n_shingles > 0")
    classes = named.groupBy("h1", "h2").agg(F.min("doc_id").alias("doc_id"))
    classes = C.cut(named.join(classes, ["h1", "h2", "doc_id"]).select("doc_id", "h1", "h2", "signature")
                    .dropDuplicates(["doc_id"]), "minhash_classes")

    planted = forest(classes)
    shared = planted.groupBy("region").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    planted = C.cut(planted.join(shared, "region"), "forest")
    sets = C.cut(shingle_sets(docs.where("doc_id is not null"), planted.select("doc_id").distinct()), "shingle_sets")

    # rounds of best neighbours of other components, while they find links
    roots = docs.sparkSession.createDataFrame([], "node long, root long")
    tried = None
    for k in range(ROUNDS):
        near = neighbours(rooted(planted, roots))
        if tried is not None:
            near = near.join(tried, ["a", "b"], "left_anti")
        best = Window.partitionBy("b").orderBy(F.desc("prefix"), "a")
        near = C.cut(near.withColumn("rank", F.row_number().over(best)).where("rank = 1").select("a", "b"), f"pairs_{k}")
        links = C.cut(confirmed(screened(near, classes), sets, percent), f"links_{k}")
        if links.isEmpty():
            break
        tried = near if tried is None else tried.unionAll(near)
        roots = components(roots.toDF("a", "b").unionAll(links))
    # then every pair of a region that is still of two components
    left = rooted(planted, roots)
    size = left.groupBy("region").agg(F.count("*").alias("n"))
    left = C.cut(left.join(size, "region"), "forest_left")
    pairs = region_pairs(left.where(F.col("n") <= FEW))
    if tried is not None:
        pairs = pairs.join(tried, ["a", "b"], "left_anti")
    few = C.cut(confirmed(screened(C.cut(pairs, "pairs_few"), classes), sets, percent), "links_few")
    crowded = by_depth(left.where(F.col("n") > FEW)).join(sets, "doc_id")
    many = C.cut(block_links(C.cut(blocks(crowded), "forest_blocks"), percent), "links_many")
    joined = components(roots.toDF("a", "b").unionAll(few).unionAll(many))

    # a class's component, named after the least document of its classes
    of_class = (classes.select("doc_id", "h1", "h2")
                .join(joined.select(F.col("node").alias("doc_id"), "root"), "doc_id", "left")
                .select("h1", "h2", F.coalesce("root", "doc_id").alias("component")))
    out = signed.select("doc_id", "h1", "h2", "n_shingles").join(of_class, ["h1", "h2"], "left")
    linked = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    component = F.coalesce(F.when(linked, F.col("component")), F.col("doc_id"))
    return out.select(F.col("doc_id").alias(id_col), "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op9_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(C.table(spark, sf_dir, "documents"))
