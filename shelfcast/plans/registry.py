"""Registry of named queries and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfcast.plans.normalize import finalize
from shelfcast.session import ensure_checkpoint_dir, ship_code

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, normalize: bool = True):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` (with its oracle)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            ship_code(spark)
            out = fn(spark, sf_dir)
            return finalize(out) if normalize else out
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every query module so that they register themselves."""
    from shelfcast.plans import (q_explore, q_features, q_forecast, q_drift,  # noqa: F401
                                 q_orders, q_prep, q_stream)
