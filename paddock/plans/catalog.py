"""Registry of named queries and their DuckDB oracle SQL.

Each query is a function ``(spark, sf_dir) -> DataFrame`` over the driver's
tables; its oracle is an independent SQL statement over the same tables.
Float outputs are rounded to 6 places and integer outputs are BIGINT on both
sides, so engine-specific last-bit and width differences do not count.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.session import apply_defaults, compiled_methods, grow_partitions

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn`` under ``name``; ``oracle`` is its DuckDB SQL (optional)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            compiled_methods(grow_partitions(apply_defaults(spark)))     # UTC, AQE, ... also on a caller's own session
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def r6(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), 6)


def load_all() -> None:
    """Import the modules that register queries."""
    from paddock.plans import (  # noqa: F401
        q_history, q_metrics, q_ingest, q_features, q_splits, q_monitor, q_models, q_sources)
