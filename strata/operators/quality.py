"""Data-quality operators (Q-1..Q-3, A-14, V-1).

Reports are small DataFrames (one row, or one row per column / table), built
from one aggregate pass each; nothing is collected inside an operator. The
caller decides when to run, print or store them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import EMAIL_PATTERN, is_valid_email


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


# ---------------------------------------------------------------------------
# Q-1 missing values
# ---------------------------------------------------------------------------

def missing_report(df: DataFrame, fraction: float | None = None, seed: int = 42,
                   sample_key: str | None = None) -> DataFrame:
    """NULL count and ratio per column: ``column, missing_count, missing_ratio``.

    Exact by default. With ``fraction`` the report runs on a sample, as the
    reference does with 1 %: a Bernoulli one (``sample(False, fraction, seed)``),
    or with ``sample_key`` the same rows each time (:func:`hash_sample`). The
    ratio is 0 when the sample is empty. NaN and empty strings are values,
    not missing.
    """
    src = df
    if fraction:
        src = (hash_sample(df, sample_key, fraction) if sample_key
               else df.sample(withReplacement=False, fraction=fraction, seed=seed))
    cols = src.columns
    counted = src.agg(F.count(F.lit(1)).alias("__total"),
                      *[F.count_if(_q(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing_count"))
             for i, c in enumerate(cols)]
    long = counted.select("__total", F.explode(F.array(*pairs)).alias("r"))
    return long.select(
        F.col("r.column").alias("column"),
        F.col("r.missing_count").alias("missing_count"),
        F.when(F.col("__total") > 0, F.col("r.missing_count") / F.col("__total"))
         .otherwise(F.lit(0.0)).alias("missing_ratio"),
    )


# ---------------------------------------------------------------------------
# E-2 sample by key
# ---------------------------------------------------------------------------

def hash_sample(df: DataFrame, key: str, share: float) -> DataFrame:
    """E-2: about ``share`` of the rows, chosen by a digest of ``key``: a row is in
    or out whatever the partitioning, the run or the engine, and all rows of a key
    are. ``df.sample`` depends on how rows are dealt, so its figures differ between
    runs. Rows without a key are out."""
    drawn = F.conv(F.substring(F.md5(_q(key).cast("string")), 1, 8), 16, 10).cast("long")
    return df.where(drawn < int(round(share * (1 << 32))))


# ---------------------------------------------------------------------------
# Q-2 duplicates
# ---------------------------------------------------------------------------

def duplicate_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``total_rows, distinct_keys, duplicate_count, duplicate_ratio``.

    NULL keys compare equal (as in ``dropDuplicates``). The per-key count is
    a hash aggregate with a map-side partial step, so a key that holds a large
    share of the rows is reduced before the shuffle.
    """
    per_key = df.groupBy(*[_q(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))
    stats = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_rows"),
                        F.count(F.lit(1)).alias("distinct_keys"))
    dup = F.col("total_rows") - F.col("distinct_keys")
    return stats.select(
        "total_rows", "distinct_keys", dup.alias("duplicate_count"),
        F.when(F.col("total_rows") > 0, dup / F.col("total_rows"))
         .otherwise(F.lit(0.0)).alias("duplicate_ratio"),
    )


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per key: the one with the smallest ``order_by`` tuple.

    Remaining columns break ties, so the survivor is deterministic (and a
    retried task picks the same row). NULLs sort first. Implemented as
    ``min(struct(...))`` per key: an aggregate with a partial step, so a key
    with millions of rows is cut down per map task instead of being sorted in
    one window partition.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.dropDuplicates(keys)
    order = [c for c in (order_by or []) if c in others]
    packed_cols = order + [c for c in others if c not in order]
    packed = F.struct(*[_q(c).alias(f"f{i}") for i, c in enumerate(packed_cols)])
    best = df.groupBy(*[_q(k) for k in keys]).agg(F.min(packed).alias("__best"))
    by_name = {c: F.col(f"__best.f{i}").alias(c) for i, c in enumerate(packed_cols)}
    return best.select(*[(_q(c) if c in keys else by_name[c]) for c in df.columns])


# ---------------------------------------------------------------------------
# Q-3 e-mail validity
# ---------------------------------------------------------------------------

def email_report(df: DataFrame, email_col: str = "email", pattern: str = EMAIL_PATTERN) -> DataFrame:
    """One row: ``valid_email_count, invalid_email_count, null_email_count,
    total_count, invalid_email_ratio``.

    NULL addresses count in the total but are neither valid nor invalid. An
    empty input gives zeros.
    """
    ok = is_valid_email(email_col, pattern)
    stats = df.agg(F.count_if(ok).alias("valid_email_count"),
                   F.count_if(~ok).alias("invalid_email_count"),
                   F.count_if(_q(email_col).isNull()).alias("null_email_count"),
                   F.count(F.lit(1)).alias("total_count"))
    return stats.withColumn(
        "invalid_email_ratio",
        F.when(F.col("total_count") > 0, F.col("invalid_email_count") / F.col("total_count"))
         .otherwise(F.lit(0.0)))


def drop_invalid_email(df: DataFrame, email_col: str = "email", pattern: str = EMAIL_PATTERN,
                       keep_null_if_clean: bool = False) -> DataFrame:
    """Keep rows with a valid address.

    By default NULL addresses are dropped too. ``keep_null_if_clean=True``
    follows the reference rule: when no address is invalid the input is
    returned unchanged (NULLs stay). That rule needs the global invalid count;
    it is a scalar subquery that Spark runs once, ahead of the filter. When
    ``df`` ends in a shuffle (the de-duplicated users), the subquery reuses
    that shuffle at run time (``ReusedExchange``), so the input is not
    scanned and shuffled twice.
    """
    ok = is_valid_email(email_col, pattern)
    if not keep_null_if_clean:
        return df.where(ok)
    n_invalid = df.select(F.count_if(~ok)).scalar()
    return df.where(ok | (n_invalid == F.lit(0)))


# ---------------------------------------------------------------------------
# A-14 / V-1 audits
# ---------------------------------------------------------------------------

def row_count_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` for each named table (one small aggregate each)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def table_checks(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """``table_name, row_count, null_key_rows`` per table; the key columns are
    the second element of each entry. A row counts once if any key is NULL."""
    parts = []
    for name, (df, keys) in tables.items():
        any_null = F.lit(False)
        for k in keys:
            any_null = any_null | _q(k).isNull()
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count"),
                            F.count_if(any_null).alias("null_key_rows"))
                       .select(F.lit(name).alias("table_name"), "row_count", "null_key_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def preview(df: DataFrame, columns: Sequence[str], order_by: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows by ``order_by`` (a deterministic ``show``); the
    ordered limit runs as a per-partition top-n plus a merge of ``n`` rows
    per partition."""
    return df.select(*columns).orderBy(*order_by).limit(n)
