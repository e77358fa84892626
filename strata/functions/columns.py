"""Reusable Column expressions.

Everything here is a built-in Catalyst expression, so it compiles into the
surrounding whole-stage-codegen span; nothing crosses into Python per row.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = str | _dt.date | Column | None


def as_of_date(as_of: DateLike = None) -> Column:
    """The snapshot day as a DATE column.

    ``None`` means ``current_date()`` (the reference behaviour); pass a date
    for a reproducible snapshot.
    """
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.date()
    return F.lit(as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(as_of))


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """``numerator / denominator`` when the denominator is positive, else 0."""
    num = F.col(numerator) if isinstance(numerator, str) else numerator
    den = F.col(denominator) if isinstance(denominator, str) else denominator
    return F.when(den > 0, num / den).otherwise(F.lit(0))


def flag(condition: Column) -> Column:
    """1 when the condition holds, else 0 (NULL counts as 0)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def minutes_between(later: Column | str, earlier: Column | str) -> Column:
    """Whole minutes from ``earlier`` to ``later``, rounded half away from zero.

    Both sides are truncated to whole epoch seconds first; NULL if either
    side is NULL. Negative when ``later`` precedes ``earlier``.
    """
    a = F.col(later) if isinstance(later, str) else later
    b = F.col(earlier) if isinstance(earlier, str) else earlier
    return F.round((F.unix_timestamp(a) - F.unix_timestamp(b)) / 60)


def report_date(ts: Column | str = "created_at") -> Column:
    """Calendar day of an event time in the session time zone."""
    return F.to_date(F.col(ts) if isinstance(ts, str) else ts)


# Fixed value: the e-mail pattern the quality report uses.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"


def is_valid_email(email: Column | str, pattern: str = EMAIL_PATTERN) -> Column:
    """TRUE / FALSE for a non-NULL address, NULL for NULL."""
    e = F.col(email) if isinstance(email, str) else email
    return e.rlike(pattern)
