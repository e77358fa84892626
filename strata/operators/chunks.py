"""Time chunking (K-1..K-3): label rows with the n-day chunk of their time.

Chunks count whole days from an origin: ``chunk_k`` covers
``[origin + k*n days, origin + (k+1)*n days)``; rows before the origin are
``initial``; a NULL time gives a NULL label.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INITIAL = "initial"
_DAY_MICROS = 86_400_000_000


def _origin(origin: str | _dt.date | _dt.datetime) -> _dt.datetime:
    if isinstance(origin, str):
        origin = _dt.datetime.fromisoformat(origin)
    if not isinstance(origin, _dt.datetime):
        origin = _dt.datetime.combine(origin, _dt.time())
    return origin


def _origin_ts(origin) -> Column:
    return F.lit(_origin(origin).isoformat(sep=" ")).cast("timestamp")


def _time(ts: Column | str) -> Column:
    """The event time; a string is parsed, and NULL where it is no time."""
    return (F.col(ts) if isinstance(ts, str) else ts).try_cast("timestamp")


def chunk_number(ts: Column | str, origin, n_days: int) -> Column:
    """Whole n-day periods since the origin (NULL before it or for NULL)."""
    t = _time(ts)
    o = _origin_ts(origin)
    elapsed_days = F.floor((F.unix_micros(t) - F.unix_micros(o)) / F.lit(_DAY_MICROS))
    return F.when(t >= o, F.floor(elapsed_days / F.lit(n_days)).cast("long"))


def chunk_label(ts: Column | str, origin, n_days: int) -> Column:
    """``initial`` before the origin, else ``chunk_<k>``."""
    t = _time(ts)
    return (F.when(t < _origin_ts(origin), F.lit(INITIAL))
            .otherwise(F.concat(F.lit("chunk_"), chunk_number(t, origin, n_days).cast("string"))))


def chunk_folder(ts: Column | str, origin, n_days: int) -> Column:
    """Folder name of a row's chunk: ``initial`` or the chunk's first day."""
    t = _time(ts)
    start = F.date_add(F.lit(_origin(origin).date()),
                       (chunk_number(t, origin, n_days) * n_days).cast("int"))
    return (F.when(t < _origin_ts(origin), F.lit(INITIAL))
            .otherwise(F.date_format(start, "yyyy-MM-dd")))


def assign_chunk(df: DataFrame, origin, n_days: int, ts_col: str = "created_at",
                 out_col: str = "date_chunk") -> DataFrame:
    """K-1: add the chunk label column."""
    return df.withColumn(out_col, chunk_label(ts_col, origin, n_days))


def chunk_summary(df: DataFrame, origin, n_days: int, ts_col: str = "created_at") -> DataFrame:
    """K-2: ``date_chunk, records, first_at, last_at`` per chunk."""
    return (df.select(chunk_label(ts_col, origin, n_days).alias("date_chunk"), _time(ts_col).alias(ts_col))
            .groupBy("date_chunk")
            .agg(F.count(F.lit(1)).alias("records"),
                 F.min(ts_col).alias("first_at"), F.max(ts_col).alias("last_at")))


def chunk_ranges(df: DataFrame, origin, n_days: int, ts_col: str = "created_at") -> DataFrame:
    """K-3 over the data: the date range of every chunk that has rows.

    ``initial`` has no start and ends the day before the origin.
    """
    o = _origin(origin).date()
    numbers = (df.select(chunk_number(ts_col, origin, n_days).alias("k"),
                         _time(ts_col) < _origin_ts(origin)).toDF("k", "early")
               .where(F.col("k").isNotNull() | F.col("early"))
               .groupBy("k").agg(F.count(F.lit(1)).alias("records")))
    start = F.date_add(F.lit(o), (F.col("k") * n_days).cast("int"))
    return numbers.select(
        F.when(F.col("k").isNull(), F.lit(INITIAL))
         .otherwise(F.concat(F.lit("chunk_"), F.col("k").cast("string"))).alias("date_chunk"),
        F.when(F.col("k").isNotNull(), start).alias("start_date"),
        F.when(F.col("k").isNull(), F.lit(o - _dt.timedelta(days=1)))
         .otherwise(F.date_add(start, n_days - 1)).alias("end_date"),
        "records",
    )
