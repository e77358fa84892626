"""Line de-duplication over a suffix array of line ids (operator 7).

Every line with a word is a position, its id the rank of its content. Prefix
doubling sorts the suffixes by their first 1, 2, 4, ... lines: a round pairs a
position's rank with the rank as many lines further on, sorts the pairs that
occur twice or more by range, and numbers them in that order. Positions whose
prefix occurs once leave, so the rounds shrink to the repeated runs.

A run is worth deleting from ``min_words`` words on. The shortest such run that
begins, and the shortest that ends, at each line has at most ``min_words``
lines, and every maximal repeated run of enough words is the union of those
inside it. So the rounds stop at that length, and two ranks - of the run's
first and last 2^k lines - name a run of any length: equal names are an
interval of suffixes whose longest common prefix reaches the run's length. The
earliest run of an interval (by document id, then line) stays, the lines of the
later ones go.

A null text has no lines and stays null; lines without a word never go and
never end a run; rows that repeat in full count as one document and fare alike;
an empty table gives no rows; other columns are kept whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: Fewest words of a run that is deleted.
MIN_WORDS = 10

LINES = ("doc {id}, k1 long, k2 long, pos int, line int, h1 long, h2 long, "
         "forward int, backward int")
KEY = ["k1", "k2"]


def document_key(id_col: Column, text: Column) -> list[Column]:
    """128 bits that stand for a row's id and text."""
    return [F.xxhash64(id_col, text).alias("k1"), F.xxhash64(F.lit(7), text, id_col).alias("k2")]


def shortest_runs(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each line, how many lines the shortest run of ``least`` words has
    that begins there, and that ends there; 0 where there is none."""
    n = len(words)
    total = np.concatenate([[0], np.cumsum(words)])
    at = np.arange(n)
    end = np.searchsorted(total, total[:-1] + least, side="left")
    begin = np.searchsorted(total, total[1:] - least, side="right") - 1
    return np.where(end <= n, end - at, 0), np.where(begin >= 0, at + 1 - begin, 0)


def positions(docs: DataFrame, min_words: int) -> DataFrame:
    """A row per line with a word. ``docs``: doc, text, k1, k2."""
    def split(batch):
        rows, pos, number, h1, h2, forward, backward = [], [], [], [], [], [], []
        for row, raw in enumerate(C.raw_texts(batch)):
            lines = [(i, s) for i, line in enumerate(raw.split(b"\n")) if (s := line.strip())]
            if not lines:
                continue
            f, b = shortest_runs(np.array([len(s.split()) for _, s in lines]), min_words)
            rows += [row] * len(lines)
            pos += range(len(lines))
            number += [i for i, _ in lines]
            for _, s in lines:
                digest = xxhash.xxh3_128_digest(s)
                h1.append(int.from_bytes(digest[:8], "little", signed=True))
                h2.append(int.from_bytes(digest[8:], "little", signed=True))
            forward.append(f)
            backward.append(b)
        if not rows:
            return None
        rows = pa.array(rows, pa.int64())
        return {"doc": batch.column("doc").take(rows), "k1": batch.column("k1").take(rows),
                "k2": batch.column("k2").take(rows), "pos": pos, "line": number, "h1": h1, "h2": h2,
                "forward": np.concatenate(forward), "backward": np.concatenate(backward)}

    id_type = docs.schema["doc"].dataType.simpleString()
    return C.map_batches(docs, split, LINES.format(id=id_type), ("text", 1 << 21))


def ranked(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """``pairs`` (k1, k2, pos, left, right) whose pair occurs at two positions or
    more, with the pair's rank: sorted by range, numbered in that order."""
    twice = pairs.groupBy(left, right).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    order = (twice.repartitionByRange(left, right).sortWithinPartitions(left, right)
             .withColumn("rank", F.monotonically_increasing_id()))
    return pairs.join(order, [left, right]).select(*KEY, "pos", "rank")


def suffix_ranks(lines: DataFrame, depth: int) -> list[DataFrame]:
    """Level k: (k1, k2, pos, rank) of the positions whose first 2^k lines occur
    elsewhere too. Each level is stored, so ranks are the same in every use."""
    levels = [C.cut(ranked(lines, "h1", "h2"), "line_ranks_0")]
    for k in range(1, depth + 1):
        a = levels[-1].withColumnRenamed("rank", "r1")
        b = levels[-1].select(*KEY, (F.col("pos") - F.lit(1 << (k - 1))).alias("pos"), F.col("rank").alias("r2"))
        levels.append(C.cut(ranked(a.join(b, [*KEY, "pos"]), "r1", "r2"), f"line_ranks_{k}"))
    return levels


def later_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """(k1, k2, start, len) of the shortest runs that stand earlier too."""
    depth = max(0, min_words.bit_length() - 1)
    levels = suffix_ranks(lines.select(*KEY, "pos", "h1", "h2"), depth)
    runs = (lines.select("doc", *KEY, F.col("pos").alias("start"), F.col("forward").alias("len"))
            .unionAll(lines.select("doc", *KEY, (F.col("pos") + 1 - F.col("backward")).alias("start"),
                                   F.col("backward").alias("len")))
            .where("len > 0"))
    named = None
    for k, level in enumerate(levels):
        some = runs.where((F.col("len") >= 1 << k) & (F.col("len") < 2 << k))
        first = level.select(*KEY, F.col("pos").alias("start"), F.col("rank").alias("first"))
        last = level.select(*KEY, F.col("pos").alias("tail"), F.col("rank").alias("last"))
        some = some.join(first, [*KEY, "start"])
        if k == 0:
            some = some.withColumn("last", F.col("first"))
        else:
            some = some.withColumn("tail", F.col("start") + F.col("len") - F.lit(1 << k)).join(
                last, [*KEY, "tail"]).drop("tail")
        some = some.select("doc", *KEY, "start", "len", "first", "last")
        named = some if named is None else named.unionAll(some)
    # a line's two runs are often the same
    named = C.cut(named.distinct(), "line_runs")
    place = F.struct(F.col("doc").isNull().alias("null_last"), "doc", *KEY, "start")
    earliest = named.groupBy("len", "first", "last").agg(F.min(place).alias("e"), F.count("*").alias("n")).where("n > 1")
    # stored, so that the join's shuffle is its own: AQE may split a run that stands often
    earliest = C.cut(earliest, "line_earliest")
    return (named.join(earliest, ["len", "first", "last"])
            .where((F.col("k1") != F.col("e.k1")) | (F.col("k2") != F.col("e.k2")) | (F.col("start") != F.col("e.start")))
            .select(*KEY, "start", "len"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_words: int = MIN_WORDS, out_col: str = "deleted") -> DataFrame:
    """``docs`` without the lines of later copies, and ``out_col`` (in place of
    any column of that name): how many lines with a word each document had and
    lost, struct<lines, lost>."""
    docs = docs.drop(out_col)
    keyed = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"),
                        *document_key(F.col(id_col), F.col(text_col)))
    # rows that repeat in full are one document here
    lines = positions(keyed, min_words).dropDuplicates([*KEY, "pos"])
    with C.temporary(docs.sparkSession):
        lines = C.cut(lines, "lines")
        runs = C.cut(later_runs(lines, min_words), "line_later")
        gone = (runs.select(*KEY, F.explode(F.sequence("start", F.col("start") + F.col("len") - 1)).alias("pos"))
                .join(lines.select(*KEY, "pos", "line"), [*KEY, "pos"])
                .groupBy(*KEY).agg(F.collect_set("line").alias("lost")))
        gone = C.cut(gone, "line_gone", keep=True)
    k1, k2, lost = (C.OWN + name for name in ("k1", "k2", "lost"))
    gone = gone.select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("lost").alias(lost))
    keys = document_key(F.col(id_col), F.col(text_col))
    marked = docs.withColumns({k1: keys[0], k2: keys[1]}).join(gone, [k1, k2], "left").drop(k1, k2)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import IntegerType, StructField, StructType
    out_type = StructType([StructField("lines", IntegerType()), StructField("lost", IntegerType())])
    schema = StructType([*docs.schema.fields, StructField(out_col, out_type)])
    arrow = to_arrow_schema(schema)

    def rebuild(batches):
        for batch in (part for whole in batches for part in C.slices(whole, text_col, 1 << 21)):
            kept, told = [], []
            for text, out in zip(batch.column(text_col).to_pylist(), batch.column(lost).to_pylist()):
                lines = text.split("\n") if text is not None else []
                n = sum(1 for line in lines if line.strip(" \t\n\x0b\x0c\r"))
                if out:
                    out = set(out)
                    text = "\n".join(line for i, line in enumerate(lines) if i not in out)
                kept.append(text)
                told.append({"lines": n, "lost": len(out or ())})
            columns = [pa.array(kept, arrow.field(text_col).type) if f.name == text_col else
                       pa.array(told, f.type) if f.name == out_col else batch.column(f.name) for f in arrow]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return marked.mapInArrow(rebuild, schema)


def op7_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", F.col("deleted.lines").alias("n_lines"),
                                    F.col("deleted.lost").alias("n_deleted"), "text")
