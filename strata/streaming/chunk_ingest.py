"""Incremental load of chunk folders (the streaming form of R-1 / S-6).

The chunked layout (``chunk_start=initial``, ``chunk_start=YYYY-MM-DD``, see
:func:`strata.sources.sinks.write_chunked`) is read as a Structured Streaming
file source. Each micro-batch (all new files, or at most ``max_files``) is handed to a
sink function, by default an append into a sized Parquet dataset or, with
:func:`jdbc_sink`, a batched insert into a relational table.

The checkpoint (in the shared folder) records which files were committed, so
a restarted or failed run resumes after the last committed batch instead of
reloading everything; ``availableNow`` processes what is there and stops.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import join_uri
from ..sources.commits import CommitLog
from ..sources.jdbc import write_table
from ..sources.sinks import CHUNK_COLUMN, ROWS_PER_FILE
from ..sources.staged import staged_load

MANIFEST = "manifest"
BatchSink = Callable[[DataFrame, int], None]


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity of the stream that a checkpoint belongs to; a fresh checkpoint
    is another stream."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def parquet_sink(uri: str, checkpoint: str, rows_per_file: int = ROWS_PER_FILE) -> BatchSink:
    """Add each batch to a Parquet dataset, file-sized like S-4.

    A batch has a folder of its own, named by its stream and number and written in
    overwrite mode: replayed after a failure between write and commit, it replaces
    itself. It counts once the dataset's manifest names it, so :func:`read_loaded`
    never sees half a batch, and a fresh checkpoint on an old dataset adds to it
    instead of overwriting its first batches.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = f"{stream_id(spark, checkpoint)}-{batch_id}"
        folder = join_uri(uri, "batches", name)
        (batch.hint("rebalance").write.mode("overwrite")
         .option("maxRecordsPerFile", rows_per_file).parquet(folder))
        manifest = CommitLog(spark, join_uri(uri, MANIFEST))
        done = manifest.rows()
        if name not in {c["window"] for c in done}:
            manifest.add(name, len(done) + 1, folder)
    return sink


def read_loaded(spark: SparkSession, uri: str, schema: T.StructType) -> DataFrame:
    """The rows of all batches that the manifest of a loaded dataset names."""
    return CommitLog(spark, join_uri(uri, MANIFEST)).read(schema)


def staged_sink(connect: Callable, table: str, schema: T.StructType, checkpoint: str, parts: int = 32,
                batch_size: int = 1000) -> BatchSink:
    """Load each batch into a relational table exactly once (see
    :mod:`strata.sources.staged`): a replayed batch finds itself merged."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        name = f"{stream_id(batch.sparkSession, checkpoint)}-{batch_id}"
        staged_load(batch, connect, table, name, schema, parts, batch_size)
    return sink


def jdbc_sink(url: str, table: str, properties: dict[str, str], batch_size: int = 1000
              ) -> BatchSink:
    """Append each batch to a relational table in ``batch_size`` inserts.

    At least once: a batch that fails between its insert and the commit of the
    checkpoint is inserted again on the next run, and so is a partition whose task
    is retried or speculated. Where that matters, use :func:`staged_sink`.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        write_table(batch, url, table, properties, batch_size=batch_size)
    return sink


def ingest_chunks(spark: SparkSession, source_uri: str, schema: T.StructType, sink: BatchSink,
                  checkpoint: str, max_files: int | None = None, drop_chunk_column: bool = True) -> None:
    """Load every not-yet-loaded file below ``source_uri`` and stop.

    ``schema`` is the row schema without the folder column; the folder value
    is discovered from the path. A run takes all new files in one batch, so
    every executor reads; ``max_files`` limits a batch where the sink needs it.
    """
    full = T.StructType(schema.fields + [T.StructField(CHUNK_COLUMN, T.StringType())])
    reader = spark.readStream.schema(full).option("basePath", source_uri)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.parquet(source_uri)
    if drop_chunk_column:
        stream = stream.drop(CHUNK_COLUMN)
    query = (stream.writeStream
             .foreachBatch(sink)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
