"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.session import SHUFFLE_CLEANUP, scratch_path, set_for

#: Most slots of a key filter, as a power of two: a bitmap of 8 MB.
FILTER_BITS = 26
#: Fewest slots: one word in millions passes by chance where keys are few, so that
#: few of the texts do, which hold hundreds.
FILTER_LEAST = 23
#: Slots for each key.
FILTER_ROOM = 128

#: Prefix of columns an operator adds to rows that keep all their columns.
OWN = "__strata_"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: What is to be deleted at the end of each open :func:`temporary`, innermost last.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())
TABLE = "table:"


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Deletes, at the end, what was written by :func:`cut` and :func:`bucketed` inside,
    but for what was cut with ``keep``: that belongs to the scope around it, if any.
    What leaves the scope must not depend on what is deleted."""
    mine: list[str] = []
    outer = _SCOPES.set((*_SCOPES.get(), mine))
    try:
        yield
    finally:
        _SCOPES.reset(outer)
        for path in mine:
            if path.startswith(TABLE):
                spark.sql(f"DROP TABLE IF EXISTS {path.removeprefix(TABLE)}")
                continue
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _owned(path: str, keep: bool) -> str:
    scopes = _SCOPES.get()
    if len(scopes) > keep:
        scopes[-1 - keep].append(path)
    return path


#: Settings of the writes of intermediate tables: shuffle files go when the write that
#: made them ends, not when the driver's collector next finds time; rows go to Python
#: by the thousand, since texts are long and the buffers outside the heap are kept;
#: a task writes several buckets at a time instead of sorting its rows by bucket.
WRITING = {SHUFFLE_CLEANUP: "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
           "spark.sql.maxConcurrentOutputFileWriters": "8"}


def cut(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: later reads cost a
    scan, survive lost executors and see the same rows."""
    spark = df.sparkSession
    path = _owned(scratch_path(spark, name), keep)
    with set_for(spark, WRITING):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of text whose rows share a bucket of a bucketed table, and the most buckets.
BUCKET_BYTES, MAX_BUCKETS = 1 << 24, 100_000


def bucketed(df: DataFrame, name: str, key: str, text_bytes: int, keep: bool = False) -> str:
    """Writes ``df``, made from ``text_bytes`` of text, as a table in the shared
    folder, bucketed by ``key``: what is grouped by the key later is not shuffled
    again. Returns the table's name; it goes with its scope, or who is done with it
    drops it."""
    table_name = f"strata_{name}_{uuid.uuid4().hex}"
    least = df.sparkSession.sparkContext.defaultParallelism
    buckets = min(MAX_BUCKETS, max(least, 1 + text_bytes // BUCKET_BYTES))
    path = _owned(scratch_path(df.sparkSession, name), keep)
    with set_for(df.sparkSession, WRITING):
        (df.write.format("parquet").option("compression", "zstd").bucketBy(buckets, key)
         .option("path", path).saveAsTable(table_name))
    _owned(TABLE + table_name, keep)
    return table_name


def text_bytes(docs: DataFrame, text_col: str) -> int:
    return docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0


def measured(df: DataFrame, most: int = 50_000) -> DataFrame:
    """``df`` (stored, of short rows) to be broadcast, if it turns out to have at most
    ``most`` rows: then a key with most of the other side's rows is not shuffled. Else
    as it is, and AQE splits such a key."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict | None], schema: str,
                part: tuple[str, int] | None = None) -> DataFrame:
    """``fn`` turns each Arrow batch into a dict of columns for ``schema``; with
    ``part`` each run of rows of about so many bytes of a column."""
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, *part) if part else (batch,):
                if some.num_rows and (out := fn(some)) is not None:
                    yield to_batch(out, arrow)

    return df.mapInArrow(run, schema)


def arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(StructType.fromDDL(ddl))


def to_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type)
         for f, c in ((f, columns[f.name]) for f in schema)], schema=schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The batch's texts; null reads as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def raw_texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The batch's texts as UTF-8; null reads as empty."""
    return [t or b"" for t in batch.column(name).cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, name: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose values of column ``name`` have about
    ``limit`` bytes; a longer value is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(name).cast(pa.binary())), 0)
    upto = np.append(0, np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(upto, upto[at] + limit, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, name])


def schema_with(df: DataFrame, carry: list[str], name: str, kind: str) -> StructType:
    """The fields ``carry`` of ``df`` and one more."""
    return StructType([*(df.schema[c] for c in carry), *StructType.fromDDL(f"`{name}` {kind}").fields])


def slot(key: Column, bitmap: np.ndarray) -> Column:
    """The key's slot in a key filter."""
    return F.pmod(F.xxhash64(key), F.lit(len(bitmap) << 5))


def key_filter(keys: DataFrame) -> np.ndarray:
    """A bitmap of the slots of ``keys`` (one column): a filter that lets every
    key pass, and of others one in ``FILTER_ROOM`` or fewer.

    Its size follows the number of keys up to ``FILTER_BITS``, beyond which more
    of the others pass. Only a pre-filter: an exact join follows wherever it is
    used, so a full bitmap costs time, never rows. At most ``2 ** FILTER_BITS / 32``
    words reach the driver, however many keys there are.
    """
    bits = min(FILTER_BITS, max(FILTER_LEAST, (keys.count() * FILTER_ROOM).bit_length()))
    s = F.pmod(F.xxhash64(F.col(keys.columns[0])), F.lit(1 << bits))
    words = (keys.select(s.alias("s"))
             .groupBy(F.shiftright("s", 5).alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(s % 32 as int))")).alias("m")).toArrow())
    bitmap = np.zeros(1 << (bits - 5), dtype=np.uint32)
    bitmap[words.column("w").to_numpy()] = words.column("m").to_numpy().astype(np.uint32)
    return bitmap


def passes(bitmap: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Which slots the filter lets pass."""
    slots = np.asarray(slots, dtype=np.int64)
    return (bitmap[slots >> 5] >> (slots & 31).astype(np.uint32)) & np.uint32(1) == 1


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of an array of span structs, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def rewritten(text: str, spans: list[tuple[int, int, str]]) -> str:
    """``text`` with each (start, end, name) replaced by its name; spans that overlap
    go as one, under the name of the first by start."""
    out, at = [], 0
    for start, end, name in sorted(spans):
        if start >= at:
            out += (text[at:start], name)
        at = max(at, end)
    return "".join([*out, text[at:]])


def rewrite(df: DataFrame, text_col: str, spans_col: str, name: Callable[[str], str]) -> DataFrame:
    """``df`` without ``spans_col``, each span of ``text_col`` replaced by the name of
    its kind. Row by row: no key, so rows without an id or with another's are safe."""
    order = [c for c in df.columns if c not in (text_col, spans_col)]

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col, 1 << 21):
                clean = [t and rewritten(t, [(s["start"], s["end"], name(s["kind"])) for s in spans or ()])
                         for t, spans in zip(part.column(text_col).to_pylist(), part.column(spans_col).to_pylist())]
                yield with_column(part.drop_columns([text_col, spans_col]), text_col, pa.array(clean, pa.string()))

    return (df.select(*order, text_col, spans_col).mapInArrow(run, schema_with(df, order, text_col, "string"))
            .select(*[c for c in df.columns if c != spans_col]))


def of_kinds(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def step_quantile(df: DataFrame, keys: list[str], value: str, share: float) -> DataFrame:
    """The least step that at least ``share`` of each group's rows stay within."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("n"))
    ordered = Window.partitionBy(*keys).orderBy(value)
    return (counts.withColumn("upto", F.sum("n").over(ordered))
            .withColumn("all", F.sum("n").over(Window.partitionBy(*keys)))
            .where(F.col("upto") >= F.ceil(F.col("all") * F.lit(share)))
            .groupBy(*keys).agg(F.min(value).alias(value)))
