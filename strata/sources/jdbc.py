"""Relational source and sink over JDBC (S-1, S-2, S-6, S-7, S-8).

* :func:`read_table` reads a table in ``num_partitions`` parallel range
  queries on an integer key. Bounds default to the key's real ``min`` /
  ``max`` (one pushed-down aggregate query), so ids are spread evenly instead
  of piling into the last partition as with fixed bounds 1..100000.
* the run window is a DataFrame filter, which the JDBC source pushes into
  every partition query (``PushedFilters``), so no SQL text is built by hand.
* :func:`write_table` appends in batches (``batchsize``) from every task in
  parallel; ``truncate_first`` keeps the table definition and empties it
  (``TRUNCATE ... CASCADE`` on PostgreSQL via ``cascadeTruncate``).

Nothing here starts a database; pass the URL of one you run.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collections.abc import Sequence

from ..operators.shape import (align_to_schema, date_window, drop_null_key,
                               window_condition)
from ..schemas import BRONZE

DEFAULT_PARTITIONS = 8
# Rows per round trip of a scan; without it some drivers hold a whole range in memory.
FETCH_SIZE = 10_000
# The tables the loader fills, in this order (referenced tables
# first); users are not in the reference's list.
LOAD_ORDER = ("posts", "comments", "likes")
log = logging.getLogger(__name__)


def key_bounds(spark: SparkSession, url: str, table: str, column: str,
               properties: dict[str, str], start: str | None = None, end: str | None = None,
               time_column: str = "created_at", end_mode: str = "instant"
               ) -> tuple[int | None, int | None]:
    """``(min, max)`` of an integer key over the run window's rows, computed by
    the database."""
    rows = date_window(spark.read.jdbc(url=url, table=table, properties=properties), start, end,
                       column=time_column, end_mode=end_mode)
    probe = rows.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    row = probe.first()  # one row with two values
    return (row["lo"], row["hi"]) if row else (None, None)


def key_split_points(spark: SparkSession, url: str, table: str, column: str,
                     properties: dict[str, str], num_partitions: int, window: str = "") -> list[int]:
    """Values of ``column`` that cut the table's rows in the run ``window`` (a
    condition) into ``num_partitions`` ranges of equal row counts; the database
    ranks the keys (an ``NTILE`` window) and returns at most ``num_partitions``
    rows."""
    also = f" AND {window}" if window else ""
    tiles = (f"(SELECT MIN({column}) AS lo FROM (SELECT {column}, NTILE({num_partitions}) "
             f"OVER (ORDER BY {column}) AS tile FROM {table} WHERE {column} IS NOT NULL{also}) ranked "
             f"GROUP BY tile) split_points")
    # by position: databases differ in the case of unquoted column names
    starts = sorted(r[0] for r in spark.read.jdbc(url=url, table=tiles,
                                                  properties=properties).collect())
    return starts[1:]   # the first tile starts at the minimum: not a cut


def range_predicates(column: str, points: Sequence[int]) -> list[str]:
    """One ``WHERE`` clause per range between consecutive ``points``; NULL
    keys go with the first range, so every row is read exactly once."""
    bounds = [None, *points, None]
    preds = []
    for lo, hi in zip(bounds, bounds[1:]):
        parts = ([f"{column} >= {lo}"] if lo is not None else []) + \
                ([f"{column} < {hi}"] if hi is not None else [])
        preds.append(" AND ".join(parts) if parts else "1 = 1")
    preds[0] = f"({preds[0]}) OR {column} IS NULL"
    return preds


def read_table(spark: SparkSession, url: str, table: str, column: str,
               properties: dict[str, str], start: str | None = None, end: str | None = None,
               lower_bound: int | None = None, upper_bound: int | None = None,
               num_partitions: int = DEFAULT_PARTITIONS, time_column: str = "created_at",
               end_mode: str = "instant", split: str = "range",
               fetch_size: int = FETCH_SIZE) -> DataFrame:
    """Partitioned scan of ``table`` split on ``column``, within the run window.

    Ids grow with time, so a window is a narrow id range: bounds and split
    points come from the window's rows, not the table's. ``split="range"``
    (the reference's scheme) cuts ``[lower, upper]`` into equal strides; bounds
    only set the stride, rows outside them are still read by the edge
    partitions. When ids are dense in one range and sparse elsewhere, a few
    strides hold most rows: ``split="quantile"`` cuts at equal row counts
    instead (:func:`key_split_points`, one ranking query in the database). A
    table without ``time_column`` is read whole. A task fetches ``fetch_size``
    rows per round trip.
    """
    properties = {"fetchsize": str(fetch_size), **properties}
    if split == "quantile":
        window = ""
        if start and end and time_column in spark.read.jdbc(
                url=url, table=table, properties=properties).columns:
            window = window_condition(start, end, time_column, end_mode)
        points = key_split_points(spark, url, table, column, properties, num_partitions, window)
        df = spark.read.jdbc(url=url, table=table, predicates=range_predicates(column, points),
                             properties=properties)
    elif split == "range":
        if lower_bound is None or upper_bound is None:
            lo, hi = key_bounds(spark, url, table, column, properties, start, end, time_column,
                                end_mode)
            lower_bound = lo if lower_bound is None else lower_bound
            upper_bound = hi if upper_bound is None else upper_bound
        if lower_bound is None or upper_bound is None or upper_bound <= lower_bound:
            df = spark.read.jdbc(url=url, table=table, properties=properties)
        else:
            df = spark.read.jdbc(url=url, table=table, column=column,
                                 lowerBound=int(lower_bound), upperBound=int(upper_bound) + 1,
                                 numPartitions=num_partitions, properties=properties)
    else:
        raise ValueError(f"split must be 'range' or 'quantile', not {split!r}")
    if start and end and time_column not in df.columns:
        log.warning("table %s has no %s column; reading it whole", table, time_column)
    return date_window(df, start, end, column=time_column, end_mode=end_mode)


def write_table(df: DataFrame, url: str, table: str, properties: dict[str, str],
                batch_size: int = 1000, truncate_first: bool = False,
                column_types: str | None = None, cascade: bool = False) -> None:
    """Append ``df`` to ``table`` in ``batch_size`` inserts per round trip.

    ``truncate_first`` empties the table (keeping its definition) before the
    load; ``column_types`` sets the DDL types when Spark creates the table
    (e.g. ``"username VARCHAR(255), content CLOB"``).
    """
    writer = df.write.option("batchsize", batch_size)
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    if truncate_first:
        writer = writer.option("truncate", "true").mode("overwrite")
        if cascade:
            writer = writer.option("cascadeTruncate", "true")
    else:
        writer = writer.mode("append")
    writer.jdbc(url=url, table=table, properties=properties)


def loadable(df: DataFrame, schema: T.StructType | None) -> DataFrame:
    """The rows of ``df`` a load inserts: NULL keys (the first column of
    ``schema``, or of ``df``) are dropped as they came, then the columns are
    aligned. A key that does not fit its type fails the load; it is never
    turned into a NULL and dropped."""
    key = schema.fields[0].name if schema is not None else df.columns[0]
    df = drop_null_key(df, key)
    return df if schema is None else align_to_schema(df, schema, strict=(key,))


def load_table(df: DataFrame, url: str, table: str, properties: dict[str, str],
               schema: T.StructType | None = None, clear_first: bool = False,
               batch_size: int = 1000) -> None:
    """S-6 + P-6 + C-1: drop rows without a key, align to the table's columns
    (:func:`loadable`), then insert in batches (optionally emptying the table
    first)."""
    write_table(loadable(df, schema), url, table, properties, batch_size=batch_size,
                truncate_first=clear_first)


def table_counts(spark: SparkSession, url: str, tables: list[str],
                 properties: dict[str, str]) -> DataFrame:
    """``table_name, row_count`` per table; each count runs in the database. A
    table that cannot be read counts -1, and the audit goes on."""
    counts = []
    for t in tables:
        try:
            row = (spark.read.jdbc(url=url, table=t, properties=properties)
                   .agg(F.count(F.lit(1)).alias("row_count")).first())
            counts.append((t, row["row_count"]))
        except Exception as e:  # noqa: BLE001  the drivers' errors have no common type
            log.warning("table %s cannot be counted: %s", t, e)
            counts.append((t, -1))
    return spark.createDataFrame(counts, "table_name string, row_count long")


# The SQL types of the target tables' columns.
SQL_TYPES = {"string": "TEXT", "bigint": "BIGINT", "date": "DATE", "timestamp": "TIMESTAMP",
             "double": "DOUBLE PRECISION"}


def create_table_sql(table: str, schema: T.StructType) -> str:
    """S-8: the statement that creates ``table`` if it is not there, its first
    column the primary key; run it with the database's own client."""
    columns = [f"{f.name} {SQL_TYPES[f.dataType.simpleString()]}" + " PRIMARY KEY" * (i == 0)
               for i, f in enumerate(schema.fields)]
    return f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)})"


def load_tables(spark: SparkSession, sources: dict[str, DataFrame], url: str,
                properties: dict[str, str], order: Sequence[str] = LOAD_ORDER,
                schemas: dict[str, T.StructType] | None = None, clear_first: bool = True,
                batch_size: int = 1000) -> DataFrame:
    """R-1: load the sources named in ``order`` one table after the other
    (each load is one distributed, batched insert, see :func:`load_table`),
    then return ``table_name, row_count`` for every table in ``sources``.

    Tables load in sequence so that referenced rows exist before the rows
    that point at them; within a table every task inserts its own rows.
    """
    schemas = BRONZE if schemas is None else schemas
    for name in order:
        if name in sources:
            load_table(sources[name], url, name, properties, schema=schemas.get(name),
                       clear_first=clear_first, batch_size=batch_size)
    return table_counts(spark, url, list(sources), properties)
