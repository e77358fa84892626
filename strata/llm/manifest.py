"""Merkle dataset manifest with octopus multiproofs (operator 12).

Every row is a leaf: the digest of its fields, each written with its length. The
leaves of a group (here a language) are its tree's, in the order of their ids;
two neighbours become their digest, level by level (a last one alone becomes the
digest of itself), until one is left. The groups' roots are the leaves of one
more tree, whose root stands for the dataset.

A tree is cut into runs of ``RUN`` leaves. A run folds to one node, runs of those
fold again, and so on: a few passes whatever the size. For proofs, a run works
out the union of the node coordinates that any of its leaves is missing (inside
the run it can derive everything, so what is missing are the edges above), gets
these in one join, derives the shared interior nodes once and writes each leaf's
proof from them. No row of one leaf ever asks for a node by itself.

A group may hold most of the rows: places are counted by parts of a range
partitioning, and ties are broken by arrival, so no part grows with a key.
A null group is a group of its own and comes first; a null field is ``-``; rows
with a null id come first, rows with the same id are ordered by their leaf, rows
that repeat in full each have a leaf. An empty table has no rows and no root;
other columns do not count, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import common as C

#: Levels that a run folds; it has two to this power of leaves.
LEVELS = 10

TREE, LEAF, POS, COUNT, RUN = (C.OWN + n for n in ("tree", "leaf", "pos", "count", "run"))
NODES = f"`{TREE}` string, `{COUNT}` long, level int, idx long, hash string"
STEPS = "array<struct<left:string,right:string>>"


# --- digests ----------------------------------------------------------------

def digest(*parts: Column) -> Column:
    """Lower-case hex of the joined parts' SHA-256."""
    return F.sha2(F.concat(*parts), 256)


def leaf(*fields: Column) -> Column:
    """The digest of a row's fields: ``-`` for null, else byte count, colon, value."""
    def written(field: Column) -> Column:
        value = field.cast("string")
        return F.when(field.isNull(), F.lit("-")).otherwise(
            F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return digest(*[written(f) for f in fields])


def folded(start: Column, proof: Column) -> Column:
    """The root that ``start`` leads to by ``proof``."""
    return F.aggregate(proof, start, lambda acc, step: digest(
        F.coalesce(step["left"], F.lit("")), acc, F.coalesce(step["right"], F.lit(""))))


def join_digests(a: str, b: str = "") -> str:
    return hashlib.sha256((a + b).encode()).hexdigest()


def fold(hashes: list[str], levels: int) -> list[list[str]]:
    """The nodes of ``levels`` levels above neighbouring nodes, and these first."""
    out = [hashes]
    for _ in range(levels):
        below = out[-1]
        out.append([join_digests(*below[i:i + 2]) for i in range(0, len(below), 2)])
    return out


def depth(count: int) -> int:
    """Levels above the leaves of a tree with so many."""
    return max(count - 1, 0).bit_length()


def missing(first: int, upto: int, count: int) -> list[tuple[int, int]]:
    """The (level, index) of the nodes that the leaves ``first`` up to ``upto`` of
    ``count`` lack, taken together, to reach the root: none that they can derive,
    none twice."""
    out = []
    for level in range(depth(count)):
        if first & 1:
            out.append((level, first - 1))
        if upto & 1 and upto < count:
            out.append((level, upto))
        first, upto, count = first >> 1, (upto + 1) >> 1, (count + 1) >> 1
    return out


# --- trees ------------------------------------------------------------------

def place(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` (with the tree and the leaf of each) and the place of each in its
    tree in the order of the columns ``order``, and the tree's number of leaves."""
    tie, part = C.OWN + "tie", C.OWN + "part"
    order = [F.asc_nulls_first(c) for c in [*order, tie]]
    ranged = C.cut(rows.withColumn(tie, F.monotonically_increasing_id())
                   .repartitionByRange(F.asc(TREE), *order)
                   .withColumn(part, F.spark_partition_id()), name)
    ahead = Window.partitionBy(TREE).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy(TREE, part).agg(F.count("*").alias("n")).select(
        TREE, part, F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias(C.OWN + "base"),
        F.sum("n").over(Window.partitionBy(TREE)).alias(COUNT))
    within = F.row_number().over(Window.partitionBy(TREE, part).orderBy(*order))
    placed = ranged.join(parts, [TREE, part]).withColumn(POS, (F.col(C.OWN + "base") + within - 1).cast("long"))
    return C.cut(placed.drop(tie, part, C.OWN + "base"), name + "_placed")


def folds(level: int, every: bool):
    """Folds the nodes of a run at ``level``, as a function for ``applyInArrow``:
    gives every level above, or the last only."""
    def run(nodes: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("idx")
        tree, count = nodes.column(TREE)[0].as_py(), nodes.column(COUNT)[0].as_py()
        first = nodes.column("idx")[0].as_py()
        above = fold(nodes.column("hash").to_pylist(), min(LEVELS, depth(count) - level))
        rows = [(level + up, (first >> up) + i, h) for up, hashes in enumerate(above) for i, h in enumerate(hashes)
                if (up if every else up == len(above) - 1)]
        levels, at, hashes = zip(*rows)
        return pa.table({TREE: [tree] * len(rows), COUNT: pa.array([count] * len(rows), pa.int64()),
                         "level": pa.array(levels, pa.int32()), "idx": pa.array(at, pa.int64()), "hash": hashes})

    return run


def nodes(placed: DataFrame, name: str) -> DataFrame:
    """(tree, count, level, idx, hash): of every tree the nodes at the level of
    whole runs and above, its root always."""
    lowest = placed.select(TREE, COUNT, F.col(POS).alias("idx"), F.col(LEAF).alias("hash"))
    folded_ = lowest.groupBy(TREE, F.shiftright("idx", LEVELS).alias("run")).applyInArrow(folds(0, False), NODES)
    passes = [C.cut(folded_, name)]
    deepest = depth(placed.agg(F.max(COUNT)).first()[0] or 0)
    for level in range(LEVELS, deepest, LEVELS):
        below = passes[-1].where((F.col("level") == level) & (F.col(COUNT) > 1 << level))
        passes.append(C.cut(below.groupBy(TREE, F.shiftright("idx", LEVELS).alias("run"))
                            .applyInArrow(folds(level, True), NODES), name))
    out = passes[0]
    for more in passes[1:]:
        out = out.unionByName(more)
    return out


def roots(nodes_: DataFrame) -> DataFrame:
    """(tree, root) of every tree."""
    top = F.ceil(F.log2(F.col(COUNT).cast("double")))
    return nodes_.where((F.col("level") == top) & (F.col("idx") == 0)).select(TREE, F.col("hash").alias("root"))


def prove(placed: DataFrame, nodes_: DataFrame, above: DataFrame | None = None) -> DataFrame:
    """``placed`` with ``proof``, from the leaf up: at each level the sibling on
    the left or right, or neither. ``above`` (tree, steps) continues the proofs of
    a tree's leaves beyond its root."""
    runs = placed.groupBy(F.col(TREE).alias("tree"), F.col(COUNT).alias("n"), F.shiftright(POS, LEVELS).alias("run")).agg(
        F.min(POS).alias("first"), (F.max(POS) + 1).alias("upto"))

    def lacking(batch):
        rows = [(t, r, level, idx) for t, r, first, upto, n in zip(
            *(batch.column(c).to_pylist() for c in ("tree", "run", "first", "upto", "n")))
            for level, idx in missing(first, upto, n)]
        return dict(zip(("tree", "run", "level", "idx"), zip(*rows))) if rows else None

    asked = C.map_batches(runs, lacking, "tree string, run long, level int, idx long")
    got = (asked.join(nodes_.select(F.col(TREE).alias("tree"), "level", "idx", "hash"), ["tree", "level", "idx"])
           .groupBy("tree", "run").agg(F.collect_list(F.struct("level", "idx", "hash")).alias("edge")))
    help_ = runs.select("tree", "run").join(got, ["tree", "run"], "left")
    if above is None:
        help_ = help_.withColumn("steps", F.lit(None).cast(STEPS))
    else:
        help_ = help_.join(above.select(F.col(TREE).alias("tree"), "steps"), "tree", "left")

    schema = StructType([*placed.schema.fields, *StructType.fromDDL(f"proof {STEPS}").fields])
    names = placed.columns

    def expand(_, leaves: pa.Table, helped: pa.Table) -> pa.Table:
        leaves = leaves.select([*names]).sort_by(POS)
        count, places = leaves.column(COUNT)[0].as_py(), leaves.column(POS).to_numpy()
        high = depth(count)
        first = int(places[0])
        within = fold(leaves.column(LEAF).to_pylist(), min(LEVELS, high))
        # all nodes in reach, and where each level's begin
        reach, at = [], {}
        for level, hashes in enumerate(within):
            for i, h in enumerate(hashes):
                at[level, (first >> level) + i] = len(reach)
                reach.append(h)
        help_row = helped.slice(0, 1).to_pylist()[0]
        for node in help_row["edge"] or ():
            at[node["level"], node["idx"]] = len(reach)
            reach.append(node["hash"])
        beyond = help_row["steps"] or []
        sides = {side: np.full((len(places), high + len(beyond)), -1) for side in ("left", "right")}
        for level in range(high):
            own = places >> level
            for node in np.unique(own).tolist():
                here = at.get((level, node ^ 1))
                if here is not None:
                    sides["left" if node & 1 else "right"][own == node, level] = here
        for k, step in enumerate(beyond):
            for side in sides:
                if step[side] is not None:
                    sides[side][:, high + k] = len(reach)
                    reach.append(step[side])
        known = pa.array(reach, pa.string())
        taken = [known.take(pa.array(np.maximum(s.ravel(), 0), mask=s.ravel() < 0)) for s in sides.values()]
        offsets = np.arange(len(places) + 1, dtype=np.int32) * (high + len(beyond))
        proof = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(taken, names=[*sides]))
        return leaves.append_column("proof", proof)

    by_run = placed.withColumn(RUN, F.shiftright(POS, LEVELS)).groupBy(TREE, RUN)
    return by_run.cogroup(help_.groupBy("tree", "run")).applyInArrow(expand, schema)


def manifest(rows: DataFrame, group_col: str, order: list[str]) -> DataFrame:
    """``rows`` (leaf, group, id and more) with ``proof`` (all the way to the
    root), ``subroot`` of the group and ``root``. ``rows`` has the leaf in the
    column ``LEAF``."""
    # the null group sorts first, and an empty name is not null
    tree = F.when(F.col(group_col).isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), F.col(group_col).cast("string")))
    placed = place(C.cut(rows.withColumn(TREE, tree), "manifest_leaves"), [*order, LEAF], "manifest_ranged")
    below = nodes(placed, "manifest_nodes")
    subroots = C.cut(roots(below), "manifest_subroots")

    tops = place(subroots.select(F.lit("").alias(TREE), F.col("root").alias(LEAF), F.col(TREE).alias("group")),
                 ["group"], "manifest_tops")
    high = nodes(tops, "manifest_high")
    top_proofs = C.cut(prove(tops, high).select(F.col("group").alias(TREE), F.col("proof").alias("steps")),
                       "manifest_steps")
    root = roots(high).select(F.max("root")).scalar()
    return (prove(placed, below, top_proofs).join(subroots.withColumnRenamed("root", "subroot"), TREE)
            .withColumn("root", root).drop(TREE, POS, COUNT))


def op12_octopus_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("decimal(20,0)")
    fields = lambda n: [F.col(c) for c in ("doc_id", "source", "lang")] + [n, F.col("text")]
    rows = docs.select(
        "doc_id", "lang", leaf(*fields(F.col("n_chars"))).alias(LEAF),
        F.when(tampered & F.col("n_chars").isNotNull(), leaf(*fields(more))).alias("tampered"))
    proved = manifest(rows, "lang", ["doc_id"])
    siblings = F.array_join(F.transform("proof", lambda s: F.concat(
        F.coalesce(s["left"], F.lit("")), F.coalesce(s["right"], F.lit("")))), "")
    out = proved.select("doc_id", F.col(LEAF).alias("leaf"), "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
                        folded(F.coalesce("tampered", LEAF), F.col("proof")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


#: Level by level over the whole table, each leaf by itself.
OP12_SQL = """
WITH RECURSIVE docs AS (
    SELECT doc_id, CAST(doc_id AS VARCHAR) AS id, source, CASE WHEN lang IS NULL THEN '' ELSE '+' || lang END AS tree,
           lang, n_chars, text FROM documents),
written AS (
    SELECT *, CASE WHEN id IS NULL THEN '-' ELSE octet_length(encode(id)) || ':' || id END
           || CASE WHEN source IS NULL THEN '-' ELSE octet_length(encode(source)) || ':' || source END
           || CASE WHEN lang IS NULL THEN '-' ELSE octet_length(encode(lang)) || ':' || lang END AS head,
           CASE WHEN text IS NULL THEN '-' ELSE octet_length(encode(text)) || ':' || text END AS tail,
           CAST(n_chars AS VARCHAR) AS n, CAST(n_chars + 1 AS VARCHAR) AS n_more,
           xor(CAST(4294967295 AS BIGINT), list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
               string_split(id, ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda crc, byte:
               list_reduce(list_prepend(xor(crc, byte), [CAST(0 AS BIGINT) FOR i IN range(8)]), lambda x, z:
                   CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END))) AS crc
    FROM docs),
leaves AS (
    SELECT doc_id, tree, sha256(head || CASE WHEN n IS NULL THEN '-' ELSE length(n) || ':' || n END || tail) AS leaf,
           CASE WHEN crc % 7 = 0 AND n IS NOT NULL THEN sha256(head || length(n_more) || ':' || n_more || tail)
                END AS tampered FROM written),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
           count(*) OVER (PARTITION BY tree) AS n, row_number() OVER () AS r FROM leaves),
nodes(level, tree, n, idx, h) AS (
    SELECT 0, tree, n, pos, leaf FROM placed
    UNION ALL
    SELECT level + 1, tree, (n + 1) // 2, idx // 2, sha256(string_agg(h, '' ORDER BY idx))
    FROM nodes WHERE n > 1 GROUP BY level, tree, n, idx // 2),
subroots AS (
    SELECT tree, level AS depth, h AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos,
           count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(level, n, idx, h) AS (
    SELECT 0, n, pos, subroot FROM subroots
    UNION ALL
    SELECT level + 1, (n + 1) // 2, idx // 2, sha256(string_agg(h, '' ORDER BY idx))
    FROM tops WHERE n > 1 GROUP BY level, n, idx // 2),
whole AS (SELECT h AS root, level AS height FROM tops WHERE n = 1),
steps AS (
    SELECT p.r, p.l AS step, CAST((p.pos >> p.l) & 1 AS VARCHAR) || coalesce(nodes.h, '') AS s
    FROM (SELECT r, placed.tree, placed.pos, unnest(range(depth)) AS l
          FROM placed JOIN subroots ON subroots.tree = placed.tree) p
    LEFT JOIN nodes ON nodes.tree = p.tree AND nodes.level = p.l AND nodes.idx = xor(p.pos >> p.l, 1)
    UNION ALL
    SELECT p.r, 1000 + p.l, CAST((p.pos >> p.l) & 1 AS VARCHAR) || coalesce(tops.h, '')
    FROM (SELECT r, subroots.pos, unnest(range(height)) AS l
          FROM placed JOIN subroots ON subroots.tree = placed.tree, whole) p
    LEFT JOIN tops ON tops.level = p.l AND tops.idx = xor(p.pos >> p.l, 1)),
proofs AS (
    SELECT r, list(s ORDER BY step) AS steps, string_agg(s[2:], '' ORDER BY step) AS siblings FROM steps GROUP BY r),
proved AS (
    SELECT doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256,
           list_reduce(list_prepend(coalesce(tampered, leaf), coalesce(steps, [])), lambda acc, s:
               sha256(CASE WHEN s[1] = '1' THEN s[2:] || acc ELSE acc || s[2:] END)) AS folded_root
    FROM placed JOIN subroots ON subroots.tree = placed.tree LEFT JOIN proofs ON proofs.r = placed.r, whole)
SELECT *, folded_root = root AS verified FROM proved
"""
