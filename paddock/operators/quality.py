"""Data-quality checks (C1-C4) as a violations DataFrame.

Required columns are checked at plan time (metadata only); null rates and
emptiness come from ONE aggregate over the frame, whatever its width.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _q(s: str) -> str:
    """Text safe inside a SQL single-quoted literal."""
    return s.replace("'", "''")


def summary(df: DataFrame, dataset: str, required: Sequence[str] = (),
            max_null_rate: float = 0.5) -> DataFrame:
    """One row (dataset, rows, violations): the row count and the violations of
    C1-C3 as an array, from one aggregate over the frame, whatever its width."""
    cols = df.columns
    # expressions as SQL text: one plan call per expression, however wide the table
    counts = df.agg(F.expr("count(1) AS _n"), *[F.expr(f"count(`{c}`) AS _c{i}") for i, c in enumerate(cols)])
    thr = f"{round(max_null_rate * 100, 1):.1f}%"
    name = f"'{_q(dataset)}'"

    def entry(column: str, error: str, value: str, message: str, order: int, found: str) -> str:
        return (f"named_struct('dataset', {name}, 'column', '{_q(column)}', 'error_type', '{error}', "
                f"'value', {value}, 'message', {message}, '_o', {order}, 'found', {found})")

    no_value = "CAST(NULL AS DOUBLE)"
    checks = [entry(c, "missing_column", no_value, f"'{_q(f"Required column '{c}' is missing")}'", 0, "true")
              for c in required if c not in cols]
    for i, c in enumerate(cols):
        rate = f"(CASE WHEN _n > 0 THEN (_n - _c{i}) / _n END)"
        text = (f"concat('Column ', chr(39), '{_q(c)}', chr(39), ' has ', CAST(round({rate} * 100, 1) AS STRING), "
                f"'% nulls (threshold: {thr})')")
        checks.append(entry(c, "high_null_rate", rate, text, 1, f"coalesce({rate} > {float(max_null_rate)!r}, false)"))
    checks.append(entry("*", "empty_dataframe", no_value, "'DataFrame has no rows'", 2, "_n = 0"))
    kept = ("transform(filter(_checks, v -> v.found), v -> named_struct('dataset', v.dataset, 'column', v.column, "
            "'error_type', v.error_type, 'value', v.value, 'message', v.message, '_o', v._o)) AS violations")
    return (counts.selectExpr("_n", f"array({', '.join(checks)}) AS _checks")
                  .selectExpr(f"{name} AS dataset", "CAST(_n AS BIGINT) AS rows", kept))


def validate(df: DataFrame, dataset: str, required: Sequence[str] = (),
             max_null_rate: float = 0.5) -> DataFrame:
    """(dataset, column, error_type, value, message) rows, in the order
    missing columns, high null rates, empty frame."""
    return summary(df, dataset, required, max_null_rate).selectExpr("inline(violations)")


def report(checks: Sequence[DataFrame]) -> DataFrame:
    """C4: combined report; ``prefixed`` is the message with a [dataset] prefix."""
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out.withColumn("prefixed", F.concat(F.lit("["), F.col("dataset"), F.lit("] "),
                                               F.col("message"))).drop("_o")
