"""Parquet sinks: file-sized writes (S-4, S-5) and per-chunk folders (S-9).

The reference counts the rows, then repartitions to ``rows // 100_000``
partitions and writes: two passes over the input. Here a ``REBALANCE`` hint
lets AQE cut the final stage into advisory-sized partitions (splitting skewed
ones, merging small ones) and ``maxRecordsPerFile`` caps each file, in one
pass and without a driver-side count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..operators.chunks import chunk_folder
from ..session import SHUFFLE_CLEANUP, set_for

ROWS_PER_FILE = 100_000
CHUNK_COLUMN = "chunk_start"


def write_sized(df: DataFrame, uri: str, mode: str = "overwrite",
                rows_per_file: int = ROWS_PER_FILE, rebalance: bool = True,
                compression: str | None = None) -> None:
    """Write Parquet with at most ``rows_per_file`` rows per file.

    ``rebalance`` adds the ``REBALANCE`` shuffle. Leave it on when the input's
    partitioning is arbitrary (a JDBC or small-file source); turn it off when
    the rows come out of a shuffle that AQE already sized, or from a narrow map
    over files written by this sink: there it would move every row once more.
    ``compression`` is the session's unless given. The write's shuffle files go with it.
    """
    if rebalance:
        df = df.hint("rebalance")
    writer = df.write.mode(mode).option("maxRecordsPerFile", rows_per_file)
    if compression:
        writer = writer.option("compression", compression)
    with set_for(df.sparkSession, {SHUFFLE_CLEANUP: "true"}):
        writer.parquet(uri)


def write_chunked(df: DataFrame, uri: str, origin, n_days: int, ts_col: str = "created_at",
                  mode: str = "overwrite", rows_per_file: int = ROWS_PER_FILE) -> None:
    """One folder per n-day chunk: ``chunk_start=initial`` or ``=YYYY-MM-DD``.

    Rows are rebalanced on the chunk: AQE cuts a chunk larger than the
    advisory partition size into advisory-sized pieces (so a chunk that holds
    a large share of the rows is spread over many tasks) and merges small
    chunks, so every task writes time-sorted files for one or a few chunks.
    A range partitioning would give the same layout but needs a sampling
    pass that computes the whole input (text included) once more.
    """
    labelled = df.withColumn(CHUNK_COLUMN, chunk_folder(ts_col, origin, n_days))
    (labelled.hint("rebalance", CHUNK_COLUMN)
     .sortWithinPartitions(CHUNK_COLUMN, ts_col)
     .write.mode(mode)
     .option("maxRecordsPerFile", rows_per_file)
     .partitionBy(CHUNK_COLUMN)
     .parquet(uri))


def read_chunked(spark, uri: str, schema: T.StructType) -> DataFrame:
    """Read a chunked dataset of rows of ``schema`` back, with its folder value
    (declared, so it stays a string)."""
    declared = T.StructType([*(f for f in schema.fields if f.name != CHUNK_COLUMN),
                             T.StructField(CHUNK_COLUMN, T.StringType())])
    return spark.read.schema(declared).parquet(uri)
