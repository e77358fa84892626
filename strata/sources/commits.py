"""A log of what a dataset holds, so that readers see whole writes only.

A Spark write of many files is not one step. Writers put their files into a folder
of their own and add a row here last; readers take the folders that the log names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

COMMITS = T.StructType([T.StructField("window", T.StringType()), T.StructField("version", T.LongType()),
                        T.StructField("folder", T.StringType())])


def read_or_empty(spark: SparkSession, uri: str, schema: T.StructType) -> DataFrame:
    """The Parquet rows at ``uri``, none where nothing was written yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(schema).parquet(uri) if there else spark.createDataFrame([], schema)


class CommitLog:
    """Which windows a dataset holds: one row per commit, ``window, version, folder``.
    One writer at a time; readers see whole commits only."""

    def __init__(self, spark: SparkSession, uri: str):
        self.spark, self.uri = spark, uri

    def rows(self) -> list:
        """All commits, first to last; one row per window."""
        return read_or_empty(self.spark, self.uri, COMMITS).orderBy("version").collect()

    def add(self, window: str, version: int, folder: str) -> None:
        self.spark.createDataFrame([(window, version, folder)], COMMITS).coalesce(1).write.mode("append").parquet(self.uri)

    def read(self, schema: T.StructType) -> DataFrame:
        """The rows of all committed folders."""
        parts = [self.spark.read.schema(schema).parquet(c["folder"]) for c in self.rows()]
        return reduce(DataFrame.unionByName, parts, self.spark.createDataFrame([], schema))
