"""Projections, filters and schema shaping (C-1, P-6, P-7, S-2)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def align_to_schema(df: DataFrame, schema: T.StructType, safe: bool = True,
                    strict: Sequence[str] = ()) -> DataFrame:
    """Keep the schema's columns in its order, cast to its types; add the
    missing ones as typed NULLs; drop everything else (e.g. a stray label).

    ``safe`` casts with ``try_cast`` so a bad value becomes NULL instead of
    failing the job under ANSI mode. A value of a ``strict`` column (a key) that
    cannot be cast fails the job in any mode.
    """
    present = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in present:
            c = F.col(f"`{f.name}`")
            if f.name in strict:
                bad = c.isNotNull() & c.try_cast(f.dataType).isNull()
                error = F.raise_error(F.concat(F.lit(f"{f.name} does not fit {f.dataType.simpleString()}: "),
                                               c.cast("string")))
                cols.append(F.when(bad, error).otherwise(c.try_cast(f.dataType)).alias(f.name))
                continue
            cols.append((c.try_cast(f.dataType) if safe else c.cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


REJECTS = "array<struct<column:string,value:string,reason:string>>"


def find_rejects(df: DataFrame, schema: T.StructType, key: str) -> DataFrame:
    """``df`` with ``__rejects``: what of a row :func:`align_to_schema` and
    :func:`drop_null_key` would drop without a word, one entry per value that does
    not fit its column's type (``cannot cast``) and one for a missing ``key``."""
    def entry(column: str, value, reason: str):
        return F.struct(F.lit(column).alias("column"), value.alias("value"), F.lit(reason).alias("reason"))

    entries = []
    for f in schema.fields:
        if f.name in df.columns:
            c = F.col(f"`{f.name}`")
            entries.append(F.when(c.isNotNull() & c.try_cast(f.dataType).isNull(), entry(
                f.name, c.cast("string"), f"cannot cast to {f.dataType.simpleString()}")))
    missing = F.col(f"`{key}`").isNull() if key in df.columns else F.lit(True)
    entries.append(F.when(missing, entry(key, F.lit(None).cast("string"), "missing key")))
    return df.withColumn("__rejects", F.filter(F.array(*entries), lambda e: e.isNotNull()))


def align_with_rejects(df: DataFrame, schema: T.StructType, key: str | None = None
                       ) -> tuple[DataFrame, DataFrame]:
    """C-1 + P-6 with what they reject: the rows to load, aligned, and
    ``row_key, column, value, reason`` of every value or key that did not fit.

    A row with a value that does not fit still loads, with NULL there, as before; a
    row whose key is missing or does not fit its type does not load. Both come from
    one projection, so persist or store ``find_rejects``' input when it is dear."""
    key = key or schema.fields[0].name
    told = find_rejects(df, schema, key)
    bad_key = F.exists("__rejects", lambda e: e["column"] == key)
    aligned = align_to_schema(told.where(~bad_key).drop("__rejects"), schema)
    row_key = F.col(f"`{key}`").cast("string") if key in df.columns else F.lit(None).cast("string")
    rejects = told.select(row_key.alias("row_key"), F.explode("__rejects").alias("r")).select(
        "row_key", "r.column", "r.value", "r.reason")
    return aligned, rejects


def drop_null_key(df: DataFrame, key: str | None = None) -> DataFrame:
    """Drop rows whose key (default: the first column) is NULL."""
    return df.dropna(subset=[key or df.columns[0]])


def _ts(value: str | _dt.date | _dt.datetime):
    """A TIMESTAMP literal read in the session time zone (constant-folded,
    so a comparison against it still pushes down)."""
    if isinstance(value, str):
        value = _dt.datetime.fromisoformat(value)
    if not isinstance(value, _dt.datetime):
        value = _dt.datetime.combine(value, _dt.time())
    return F.lit(value.isoformat(sep=" ")).cast("timestamp")


def window_condition(start: str, end: str, column: str = "created_at",
                     end_mode: str = "instant") -> str:
    """The condition of :func:`date_window` as SQL text, for a query that the
    database plans itself."""
    day = _dt.date.fromisoformat(end)
    last = {"instant": f"<= TIMESTAMP '{day} 00:00:00'",
            "day": f"< TIMESTAMP '{day + _dt.timedelta(days=1)} 00:00:00'"}[end_mode]
    return (f"{column} >= TIMESTAMP '{_dt.date.fromisoformat(start)} 00:00:00' "
            f"AND {column} {last}")


def date_window(df: DataFrame, start=None, end=None, column: str = "created_at",
                end_mode: str = "instant") -> DataFrame:
    """Rows whose ``column`` falls in the run window.

    ``end_mode="instant"`` is the reference rule ``BETWEEN start AND end``
    with both days read as midnight, so rows later on the end day are out.
    ``end_mode="day"`` keeps the whole end day (half-open ``< end + 1 day``).
    Tables without the column, or a missing bound, are returned whole. Both
    bounds are plain comparisons on the column, so a Parquet or JDBC scan
    receives them as pushed filters.
    """
    if not (start and end) or column not in df.columns:
        return df
    c = F.col(column)
    lo = c >= _ts(start)
    if end_mode == "instant":
        hi = c <= _ts(end)
    elif end_mode == "day":
        end_day = _dt.date.fromisoformat(end) if isinstance(end, str) else end
        if isinstance(end_day, _dt.datetime):
            end_day = end_day.date()
        hi = c < _ts(end_day + _dt.timedelta(days=1))
    else:
        raise ValueError(f"unknown end_mode {end_mode!r}")
    return df.where(lo & hi)
