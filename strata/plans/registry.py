"""Query registry: one Spark builder and (where SQL can say it) one DuckDB
oracle statement per operator key.

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole scale-factor tables. Oracle statements run in DuckDB against the same
parquet files (tables pre-registered as views) and restate the reference
semantics directly, often in the reference's own join form, so that a Spark
plan that is rewritten for scale is checked against the plain definition.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    oracle: str | None


_REGISTRY: dict[str, Query] = {}


def register(name: str, oracle: str | None = None):
    """Decorator: register a builder under ``name`` with its oracle SQL."""
    def wrap(fn: Builder) -> Builder:
        if name in _REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        _REGISTRY[name] = Query(name, fn, oracle)
        return fn
    return wrap


def all_queries() -> dict[str, Query]:
    # importing the catalogue modules fills the registry
    from . import catalog  # noqa: F401
    return dict(_REGISTRY)
