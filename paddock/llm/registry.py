"""Registry of this folder's queries and their DuckDB SQL (where SQL can express them)."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paddock.session import apply_defaults

#: Rows of an Arrow batch: whole texts travel in batches, so fewer of them than
#: Spark's default keep both sides' buffers small.
BATCH_ROWS = 1000

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def prepare(spark: SparkSession) -> None:
    """Session defaults of the library, and small Arrow batches."""
    apply_defaults(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def query(name: str, oracle: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco
