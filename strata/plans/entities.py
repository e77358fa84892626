"""Bronze and silver jobs per entity (B-1..B-4, T-1..T-4) as configuration."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..operators import quality
from ..operators.shape import date_window


@dataclass(frozen=True)
class Entity:
    name: str
    id_col: str
    dedup_keys: tuple[str, ...]
    # survivor order for de-duplication; empty = all columns in table order
    dedup_order: tuple[str, ...] = ()
    email_col: str | None = None
    time_col: str | None = "created_at"
    reports: tuple[str, ...] = field(default=("missing", "duplicates"))


ENTITIES: dict[str, Entity] = {
    "users": Entity("users", "user_id", ("user_id",), (), email_col="email", time_col=None,
                    reports=("missing", "duplicates", "email")),
    "posts": Entity("posts", "post_id", ("post_id",), ("created_at", "post_id")),
    "comments": Entity("comments", "comment_id", ("comment_id",), ("created_at", "comment_id")),
    # The reference de-duplicates likes on user_id (one like per user survives).
    "likes": Entity("likes", "like_id", ("user_id",), ("created_at", "like_id")),
}

# What the pipeline uses for likes: one row per like.
LIKES_BY_ID = Entity("likes", "like_id", ("like_id",), ("created_at", "like_id"))


def bronze(source: DataFrame, entity: Entity, start: str | None, end: str | None,
           end_mode: str = "instant") -> DataFrame:
    """B-n: the run window of a source table (whole table without a time column)."""
    if entity.time_col is None:
        return source
    return date_window(source, start, end, column=entity.time_col, end_mode=end_mode)


def silver(df: DataFrame, entity: Entity, keep_null_email_if_clean: bool = True) -> DataFrame:
    """T-n: de-duplicate on the entity's key, then (users) drop invalid e-mails.

    ``keep_null_email_if_clean`` follows the reference: NULL addresses stay
    when no address is invalid.
    """
    out = quality.dedup(df, entity.dedup_keys, entity.dedup_order or None)
    if entity.email_col:
        out = quality.drop_invalid_email(out, entity.email_col,
                                         keep_null_if_clean=keep_null_email_if_clean)
    return out


def silver_reports(df: DataFrame, entity: Entity, sample_fraction: float | None = None
                   ) -> dict[str, DataFrame]:
    """The quality reports of a silver step, as lazy DataFrames.

    As in the reference, missing values and duplicates are reported on the
    input, e-mail validity on the de-duplicated rows. Each report is its own
    aggregate job over the input rather than metrics observed during the
    silver write: observed metrics in a map stage are counted again when an
    executor is lost and the stage re-runs, aggregates are not.
    """
    out: dict[str, DataFrame] = {}
    if "missing" in entity.reports:
        out["missing"] = quality.missing_report(df, fraction=sample_fraction)
    if "duplicates" in entity.reports:
        out["duplicates"] = quality.duplicate_report(df, entity.dedup_keys)
    if "email" in entity.reports and entity.email_col:
        deduped = quality.dedup(df, entity.dedup_keys, entity.dedup_order or None)
        out["email"] = quality.email_report(deduped, entity.email_col)
    return out
