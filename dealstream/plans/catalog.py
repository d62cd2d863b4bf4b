"""Registry of named queries: ``key -> (spark, sf_dir) -> DataFrame`` plus the
matching reference SQL. Each module registers its own queries on import."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``key`` (with optional SQL)."""

    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle
        return fn

    return deco


def load_all() -> None:
    # Importing the modules registers their queries.
    from . import queries_core, queries_gold, queries_io, queries_ops, queries_runlog, queries_star  # noqa: F401
