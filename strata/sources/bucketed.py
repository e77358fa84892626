"""Tables whose rows are stored by the hash of a key (G-2, J-3).

Silver tables that are joined on the same key again and again are dealt into buckets
once, when they are written; joins and aggregates on the key then read them without
an exchange. Buckets are a property of a catalog table, so the session's catalog
must last as long as the tables are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_bucketed(df: DataFrame, table: str, uri: str, key: str, buckets: int) -> DataFrame:
    """Writes ``df`` as ``table`` at ``uri``, in ``buckets`` by ``key``, one file each,
    and reads it back. Tables that meet need the same number of buckets.

    The rows are shuffled here so that each task writes one bucket; without it every
    task would write a file into every bucket.
    """
    (df.repartition(buckets, F.col(key)).write.mode("overwrite").format("parquet")
     .bucketBy(buckets, key).sortBy(key).option("path", uri).saveAsTable(table))
    return df.sparkSession.table(table)


def drop_tables(spark: SparkSession, *tables: str) -> None:
    """Forgets the tables; their files stay."""
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
