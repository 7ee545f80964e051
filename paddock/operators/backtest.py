"""Prediction frames and per-race ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paddock.operators.sequence import desc, with_position


def predicted_rank(df: DataFrame, prob: str = "predicted_prob", group: str = "race_id",
                   tie_break: Sequence[str] = ("horse_id",), name: str = "predicted_rank",
                   by: Sequence[str] = ()) -> DataFrame:
    """H6: ordinal rank (1 = highest probability) inside each race.

    Equal probabilities are ordered by ``tie_break`` so the rank is
    deterministic. A race has a bounded field, so its window is one small group.
    """
    w = Window.partitionBy(*by, group).orderBy(F.col(prob).desc(), *[F.col(c) for c in tie_break])
    return df.withColumn(name, F.row_number().over(w).cast("long"))


def min_rank(df: DataFrame, prob: str = "win_probability", group: str | None = "race_id",
             name: str = "rank") -> DataFrame:
    """``rank()`` semantics (ties share the lowest rank) by probability desc.

    Without ``group`` the ranking is global: it runs over buckets of the
    probability, not in a single-partition window.
    """
    if group:
        return df.withColumn(name, F.rank().over(Window.partitionBy(group).orderBy(F.col(prob).desc())).cast("long"))
    out = with_position(df, [], [desc(prob)], name=name, ties=True)
    return out.withColumn(name, (F.col(name) + 1).cast("long"))


def prediction_frame(df: DataFrame, threshold: float = 0.5, prob: str = "predicted_prob",
                     target: str = "is_win", ids: Sequence[str] = ("race_id", "horse_id"),
                     betting: Sequence[str] = ("odds", "bet_amount", "payout"),
                     extra: Sequence[str] = ()) -> DataFrame:
    """H7: ids, target as ``is_win``, probability, ``predicted_win`` and the
    actual position; betting columns when present.

    A missing ``actual_position`` is an error here (the reference silently
    writes 0 for every row, which corrupts every ranking metric).
    """
    if "actual_position" not in df.columns:
        raise ValueError("prediction frame needs actual_position")
    cols: list[Column] = [F.col(c) for c in ids]
    cols += [F.col(target).cast("long").alias("is_win"),
             F.col(prob).cast("double").alias("predicted_prob"),
             (F.col(prob) >= F.lit(threshold)).cast("long").alias("predicted_win"),
             F.col("actual_position").cast("long").alias("actual_position")]
    cols += [F.col(c) for c in betting if c in df.columns]
    cols += [F.col(c) for c in extra]
    return df.select(*cols)
