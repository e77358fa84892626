"""Mixing sources to target weights by Pfair scheduling (operator 8).

Time is a row of slots, each for one block of some source. Block j of a source
of weight w is released at floor(j / w) and due at ceil((j + 1) / w); in each slot
the released block with the earliest deadline runs. The weights add up to one, so
every block meets its deadline, and after any number of slots a source is less
than one block away from its weight. Weights are whole millionths of millionths;
nothing repeats after a period, so this holds however long the mix is.

The schedule is worked out in stretches of ``STRETCH`` slots side by side. At the
begin of a stretch all blocks that are due have run, and of the next ones, as many
as there were slots for, those due first: from any such state no deadline is missed.
The states are then compared with those in which the stretches before end, and
stretches that began otherwise are worked out again, until all agree; then this is
the schedule that one pass over all slots would give. (States differ rarely and
meet again after a few slots, so two or three rounds do.)

A source's documents stand in the order of a digest of their ids and texts, cut into
blocks of equal bytes. The mix lasts until every document has stood in it once:
sources that end before begin again (``epoch``), so no document is dropped.
A source's order is found bucket by bucket, with the buckets' totals in front,
so one source with most of the corpus is spread over all tasks; buckets are made
finer until none holds more than ``BUCKET_BYTES``.

DataFrame operations only. A null source is a source; a null text has no bytes
and still a place; rows that repeat in full each have one; an empty table gives
no rows; other columns are kept whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

#: Bytes of a block: about two sequences of 2048 tokens.
BLOCK_BYTES = 16_384
#: Units of weight in all.
UNITS = 10 ** 12
#: Slots of a stretch of the schedule.
STRETCH = 512
#: A source's default weight: its share of bytes to this power, rescaled.
EXPONENT = 0.8
#: Bytes of a document beside its text, so that empty ones have a place.
ROW_BYTES = 8
#: Most bytes of a bucket in which documents are put in order, and the hexadecimal
#: digits of the digest that a bucket takes, at least and at most.
BUCKET_BYTES = 1 << 26
DIGITS = (3, 7)

NO_SOURCE = "\x00"


def shares(supply: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(source, bytes, idx, a): a of ``UNITS`` for each source of ``supply``.

    Every source gets one unit and the rest by largest remainder, so that all
    of them are in the mix. ``weights`` must name every source; the default is
    the share of bytes to the power ``EXPONENT``.
    """
    every = Window.partitionBy(F.lit(0))  # one row per source
    if weights is None:
        weight = F.pow(F.col("bytes").cast("double"), F.lit(EXPONENT))
    else:
        pairs = [x for s, w in weights.items() for x in (F.lit(NO_SOURCE if s is None else s), F.lit(float(w)))]
        weight = F.create_map(*pairs)[F.col("source")]
    share = (supply.withColumn("w", weight).withColumn("n", F.count("*").over(every))
             .withColumn("exact", F.col("w") / F.sum("w").over(every) * (F.lit(UNITS) - F.col("n")))
             .withColumn("whole", F.floor("exact")))
    left = F.lit(UNITS) - F.sum(F.col("whole") + 1).over(every)
    by_rest = Window.partitionBy(F.lit(0)).orderBy(F.desc(F.col("exact") - F.col("whole")), "source")
    return (share.withColumn("left", left).withColumn("extra", F.row_number().over(by_rest))
            .withColumn("idx", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("source")) - 1)
            .select("source", "bytes", "idx", (F.col("whole") + 1 + F.when(
                F.col("extra") <= F.col("left"), 1).otherwise(0)).cast("long").alias("a")))


# --- schedule -----------------------------------------------------------------

def wide(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def quotient(c: str) -> Column:
    """A whole quotient of decimals, as a long."""
    return F.expr(c).cast("long")


def stretches(plan: DataFrame, slots: int, stretch: int) -> DataFrame:
    """(k, c, done): for each stretch the sources' weights (a, and the whole and rest
    of ``UNITS`` / a) and the blocks that each has run when it begins."""
    count, many = -(-slots // stretch), 1000
    some = plan.select("idx", "a", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"),
                                                        F.lit(many).cast("long"))).alias("k0"))
    rows = some.repartition("k0").select("idx", "a", F.explode(F.sequence(
        F.col("k0"), F.least(F.col("k0") + many - 1, F.lit(count - 1).cast("long")))).alias("k"))
    rows = rows.withColumn("fluid", F.col("k").cast("decimal(19,0)") * F.lit(stretch).cast("decimal(5,0)")
                           * F.col("a").cast("decimal(13,0)"))
    rows = rows.withColumn("due_by", quotient(f"fluid div {UNITS}")).withColumn("part", F.expr(f"fluid % {UNITS} > 0"))
    due = quotient(f"(cast(due_by + 1 as decimal(24,0)) * {UNITS} + a - 1) div a")
    first = Window.partitionBy("k").orderBy(F.desc("part"), due, "idx")
    room = F.col("k") * stretch - F.sum("due_by").over(Window.partitionBy("k"))
    started = rows.withColumn("done", F.col("due_by") + F.when(
        F.col("part") & (F.row_number().over(first) <= room), 1).otherwise(0))
    each = F.struct("idx", "a", "done")
    return started.groupBy("k").agg(F.array_sort(F.collect_list(each)).alias("s")).select(
        "k", F.transform("s", lambda x: F.struct(x["a"].alias("a"), F.floor(F.lit(UNITS) / x["a"]).alias("whole"),
                                                 (F.lit(UNITS) % x["a"]).alias("rest"))).alias("c"),
        F.transform("s", lambda x: x["done"]).alias("done"))


def scheduled(rows: DataFrame, stretch: int) -> DataFrame:
    """``rows`` (k, c, done) with ``picks``, the source of each slot, and ``end``, the
    blocks that each source has run after them."""
    c = F.col("c")

    def begin(d: Column, i: Column) -> Column:
        """When the next block is released, to the fraction: whole slots from the
        stretch's begin, and the rest in parts of a."""
        at = d.cast("decimal(24,0)") * F.lit(UNITS).cast("decimal(13,0)")
        a = F.get(c, i)["a"].cast("decimal(13,0)")
        rest = (at % a).cast("long")
        whole = ((at - at % a) / a).cast("decimal(24,0)") - F.col("k").cast("decimal(19,0)") * stretch
        return F.struct(whole.cast("long").alias("q"), rest.alias("r"))

    def after(x: Column, w: Column) -> tuple[Column, Column]:
        """One block later."""
        r = x["r"] + w["rest"]
        return x["q"] + w["whole"] + F.when(r >= w["a"], 1).otherwise(0), r % w["a"]

    def step(state: Column, t: Column) -> Column:
        def due(x: Column, i: Column) -> Column:
            q, r = after(x, F.get(c, i))
            return F.when(x["q"] <= t, F.struct((q + F.when(r > 0, 1).otherwise(0)).alias("due"), i.alias("i")))

        pick = F.array_min(F.filter(F.transform(state["s"], due), lambda x: x.isNotNull()))["i"]

        def moved(x: Column, i: Column, p: Column) -> Column:
            q, r = after(x, F.get(c, i))
            return F.when(i == p, F.struct(q.alias("q"), r.alias("r"))).otherwise(x)

        # the array has one element, so that the pick is worked out once
        return F.element_at(F.transform(F.array(pick), lambda p: F.struct(
            F.transform(state["s"], lambda x, i: moved(x, i, p)).alias("s"),
            F.concat(state["picks"], F.array(p)).alias("picks"))), 1)

    start = F.struct(F.transform("done", begin).alias("s"), F.array().cast("array<int>").alias("picks"))
    picks = F.aggregate(F.sequence(F.lit(0), F.lit(stretch - 1)), start, step, lambda s: s["picks"])
    return rows.select("k", "c", "done", picks.alias("picks")).withColumn("end", F.transform(
        "done", lambda d, i: d + F.size(F.filter("picks", lambda p: p == i))))


def schedule(plan: DataFrame, slots: int, stretch: int = STRETCH) -> DataFrame:
    """(idx, k, t): the slot t of each source's block k, for ``slots`` slots and a
    few more. ``plan``: idx, a."""
    done = C.cut(scheduled(stretches(plan, slots, stretch), stretch), "mix_stretches")
    while True:
        before = done.select((F.col("k") + 1).alias("k"), F.col("end").alias("begin"))
        wrong = done.join(before, "k").where(F.col("done") != F.col("begin")).select("k", "c", F.col("begin").alias("done"))
        wrong = C.cut(wrong, "mix_wrong")
        if wrong.isEmpty():
            break
        done = C.cut(done.join(wrong.select("k"), "k", "left_anti").unionByName(scheduled(wrong, stretch)), "mix_stretches")
    slots_ = done.select("k", "done", F.posexplode("picks").alias("place", "idx"))
    turn = F.row_number().over(Window.partitionBy("k", "idx").orderBy("place")) - 1
    return slots_.select("idx", (F.get("done", F.col("idx")) + turn).alias("block"),
                         (F.col("k") * stretch + F.col("place")).alias("t"))


# --- documents ----------------------------------------------------------------

def mix(docs: DataFrame, weights: dict[str, float] | None = None, block_bytes: int = BLOCK_BYTES,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        out_col: str = "mix") -> DataFrame:
    """``docs`` with ``out_col`` (in place of any column of that name):
    struct<slot, place, epoch, block, share, units>.

    Read in the order of slot and place, any prefix holds the sources at their
    weights to within a block. A document stands once for each epoch. A source's
    weight is share / units.
    """
    docs = docs.drop(out_col)
    source, bucket, digest, size, before = (C.OWN + n for n in ("source", "bucket", "digest", "size", "before"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(text)))
    sized = docs.withColumns({
        source: F.coalesce(F.col(source_col).cast("string"), F.lit(NO_SOURCE)), digest: own,
        size: (F.octet_length(text) + ROW_BYTES).cast("long")})

    digits, most = DIGITS
    while True:
        totals = C.cut(sized.groupBy(F.col(source).alias("source"), F.substring(digest, 1, digits).alias("bucket"))
                       .agg(F.sum(size).alias("bytes")), "mix_totals")
        largest = totals.agg(F.max("bytes")).first()[0]
        if largest is None or largest <= BUCKET_BYTES or digits == most:
            break
        while digits < most and largest > BUCKET_BYTES:
            digits, largest = digits + 1, largest // 16
    plan = shares(totals.groupBy("source").agg(F.sum("bytes").alias("bytes")), weights)
    plan = C.cut(plan.withColumn("blocks", F.ceil(F.col("bytes") / block_bytes)), "mix_shares")
    # by then every source's last block is due
    slots = plan.agg(F.max(F.expr(f"(cast(blocks as decimal(24,0)) * {UNITS} + a - 1) div a"))).first()[0] or 1
    turns = C.cut(schedule(plan.select("idx", "a"), int(slots)).join(plan, "idx"), "mix_schedule")
    # the mix ends with the last slot in which some source shows its last block
    end = turns.where(F.col("block") == F.col("blocks") - 1).select(F.max("t")).scalar()
    turns = turns.where(F.col("t") <= end).select(
        F.col("source").alias(source), (F.col("block") % F.col("blocks")).alias(C.OWN + "block"),
        F.struct(F.col("t").cast("long").alias("slot"), F.floor(F.col("block") / F.col("blocks")).alias("epoch"),
                 F.col("block").cast("long").alias("block"), F.col("a").alias("share")).alias(C.OWN + "turn"))

    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("source").alias(source), F.col("bucket").alias(bucket),
                            F.coalesce(F.sum("bytes").over(ahead), F.lit(0)).alias(C.OWN + "base"))
    within = Window.partitionBy(source, bucket).orderBy(digest, size).rowsBetween(Window.unboundedPreceding, -1)
    placed = (sized.withColumn(bucket, F.substring(digest, 1, digits))
              .withColumn(before, F.coalesce(F.sum(size).over(within), F.lit(0)))
              .join(offsets, [source, bucket])
              .withColumn(before, F.col(before) + F.col(C.OWN + "base"))
              .withColumn(C.OWN + "block", F.floor(F.col(before) / block_bytes)))
    runs = placed.join(turns, [source, C.OWN + "block"])
    turn = F.col(C.OWN + "turn")
    return runs.select(*[runs[c] for c in docs.columns], F.struct(
        turn["slot"].alias("slot"), (F.col(before) % block_bytes).cast("long").alias("place"),
        turn["epoch"].alias("epoch"), turn["block"].alias("block"), turn["share"].alias("share"),
        F.lit(UNITS).cast("long").alias("units")).alias(out_col))


def op8_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "source", "mix.*")


#: Restates the definition from the weights: each block's window and the earliest
#: deadline, slot by slot in a recursive query.
OP8_SQL = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, source, coalesce(source, chr(0)) AS s, octet_length(encode(coalesce(text, ''))) + {ROW_BYTES} AS size,
           md5(coalesce(CAST(doc_id AS VARCHAR), '') || md5(coalesce(text, ''))) AS h
    FROM documents),
placed AS (
    SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY s ORDER BY h, size
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
    FROM d),
supply AS (SELECT s, CAST(sum(size) AS BIGINT) AS bytes FROM d GROUP BY s),
weighed AS (SELECT s, bytes, pow(bytes, {EXPONENT}) AS w, count(*) OVER () AS n FROM supply),
parts AS (SELECT *, w / sum(w) OVER () * ({UNITS} - n) AS exact FROM weighed),
ranked AS (
    SELECT *, CAST(floor(exact) AS BIGINT) AS whole,
           row_number() OVER (ORDER BY exact - floor(exact) DESC, s) AS extra,
           {UNITS} - sum(floor(exact) + 1) OVER () AS rest,
           row_number() OVER (ORDER BY s) - 1 AS idx FROM parts),
plan AS (
    SELECT s, idx, CAST(whole + 1 + CASE WHEN extra <= rest THEN 1 ELSE 0 END AS HUGEINT) AS a,
           CAST(ceil(bytes / {float(BLOCK_BYTES)}) AS BIGINT) AS blocks FROM ranked),
lists AS (SELECT max((CAST(blocks AS HUGEINT) * {UNITS} + a - 1) // a) AS slots, list(a ORDER BY idx) AS a FROM plan),
edf(t, done, pick) AS (
    SELECT CAST(-1 AS BIGINT), list_transform(a, lambda x: CAST(0 AS HUGEINT)), CAST(-1 AS HUGEINT) FROM lists
    UNION ALL
    SELECT t + 1, list_transform(done, lambda c, i: CASE WHEN i = p THEN c + 1 ELSE c END), p - 1
    FROM (SELECT t, done, list_min(list_transform(done, lambda c, i:
                 CASE WHEN (c * {UNITS}) // a[i] <= t + 1
                      THEN (((c + 1) * {UNITS} + a[i] - 1) // a[i]) * 1000000 + i
                      ELSE CAST('1000000000000000000000000000' AS HUGEINT) END)) % 1000000 AS p
          FROM edf, lists WHERE t + 1 < slots)),
turns AS (
    SELECT plan.*, t, row_number() OVER (PARTITION BY idx ORDER BY t) - 1 AS block
    FROM edf JOIN plan ON pick = idx),
ending AS (SELECT max(t) AS e FROM turns WHERE block = blocks - 1)
SELECT doc_id, source, CAST(t AS BIGINT) AS slot, CAST(before % {BLOCK_BYTES} AS BIGINT) AS place,
       CAST(block // blocks AS BIGINT) AS epoch, CAST(block AS BIGINT) AS block, CAST(a AS BIGINT) AS share,
       CAST({UNITS} AS BIGINT) AS units
FROM placed JOIN turns USING (s), ending
WHERE block % blocks = before // {BLOCK_BYTES} AND t <= e
"""
