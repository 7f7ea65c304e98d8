"""Registry of named queries: Spark builder + DuckDB oracle SQL.

``QUERIES[name] = fn(spark, sf_dir) -> DataFrame``; ``ORACLE[name]`` is the
SQL twin (absent for model-fitting operators, which get a rows-only check).
Every query reads the given tables in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import the modules that register queries (idempotent)."""
    from pulsegrid.plans import queries  # noqa: F401
