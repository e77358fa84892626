"""Parquet layers (S-3) and the dataset layout.

Layout: ``{base}/{layer}/{start}_{end}/{table}`` for any Hadoop URI
(``s3a://bucket``, ``hdfs://...``, ``file:/...``). Each pipeline step writes a
new dataset name, never the path it reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import join_uri


def layer_path(base: str, layer: str, start: str, end: str, table: str) -> str:
    return join_uri(base, layer, f"{start}_{end}", table)


def read_parquet(spark: SparkSession, uri: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet read; with a declared schema no footer inference runs, and the
    selected columns / filters still reach the scan (ReadSchema, PushedFilters)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(uri)
