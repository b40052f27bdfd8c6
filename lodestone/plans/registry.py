"""Registry of named queries and their independent SQL oracles.

A query is a function ``(spark, sf_dir) -> DataFrame``.  The oracle is plain
ANSI/DuckDB SQL over the same parquet tables, written separately from the
Spark plan so the check is independent of the DataFrame code.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn`` under ``key``; ``sql`` is its oracle (None = rows-only)."""

    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key!r}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql.strip()
        return fn

    return deco


def rd(expr: str, n: int = 2) -> str:
    """SQL text: round ``expr`` half away from zero to ``n`` places, as DOUBLE."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(28,8)), {n}) AS DOUBLE)"


def dsum(expr: str, scale: int = 2) -> str:
    """SQL text: exact decimal sum of a money/quantity column, as DOUBLE."""
    return f"CAST(SUM(CAST({expr} AS DECIMAL(18,{scale}))) AS DOUBLE)"


PLAN_MODULES = (
    "star",
    "text_dates",
    "kpis",
    "subqueries",
    "setops",
    "window_reports",
    "olap",
    "views",
    "state_jobs",
    "dashboards",
    "routines",
    "procedures",
    "validation",
    "incremental",
    "batch_jobs",
)


def load_all() -> None:
    """Import every plan module so their ``@query`` decorators run."""
    import importlib

    for name in PLAN_MODULES:
        importlib.import_module(f"lodestone.plans.{name}")
