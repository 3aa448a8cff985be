"""Query catalogue: every operator of the engine exercised on the driver's
tables, each with an independent SQL statement (DuckDB dialect) that computes
the same result from the same tables.

A query is a function ``(spark, root) -> DataFrame``; ``root`` is the folder
holding ``<table>.parquet``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None):
    """Register a query with its oracle SQL (None: no SQL form, rows-only)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _load_all() -> None:
    from doclake.catalog import docs, incremental, lines, misc, plans, responses, wide  # noqa: F401


def queries() -> dict[str, QueryFn]:
    _load_all()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
