"""Leakage-free per-entity history features and per-entity summaries.

Every history value of a row is computed from the rows of the same entity that
come strictly before it in the total order (date, then a unique tie-break), so
no row sees its own outcome or a later one. The windows run through
``paddock.operators.sequence`` and therefore stay within bounded tasks even for
an entity that holds a large share of all rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paddock.operators.sequence import rolling

N_PAST = 5


def _win(c: str = "finish_position") -> Column:
    return F.when(F.col(c) == 1, F.lit(1.0)).otherwise(F.lit(0.0))


def _top3(c: str = "finish_position") -> Column:
    return F.when(F.col(c) <= 3, F.lit(1.0)).otherwise(F.lit(0.0))


def horse_history(df: DataFrame, order: Sequence[str], n: int = N_PAST,
                  key: str = "horse_id", base: DataFrame | None = None) -> DataFrame:
    """Rolling finish stats over the previous ``n`` races of the entity,
    days since its previous race and the count of all earlier races (``base``:
    see ``rolling``)."""
    means = {
        "avg_finish": F.col("finish_position"),
        "win_rate": _win(),
        "top3_rate": _top3(),
    }
    if "corner_position_4" in df.columns:
        means["avg_corner_pos_4"] = F.col("corner_position_4")
    if "last_3f_time" in df.columns:
        means["avg_last_3f_time"] = F.col("last_3f_time")
    out = rolling(df, [key], order, n, means=means, lags={"_prev_date": F.col("race_date")},
                  count_name="num_past_races", base=base)
    return (out.withColumn("days_since_last_race",
                           F.datediff("race_date", "_prev_date").cast("long"))
               .drop("_prev_date"))


def jockey_history(df: DataFrame, order: Sequence[str], n: int = N_PAST,
                   key: str = "jockey_id", base: DataFrame | None = None) -> DataFrame:
    """The jockey's rolling win / top-3 rate and prior rides (``base``: see ``rolling``)."""
    if key not in df.columns:
        return df.withColumns({
            "jockey_win_rate": F.lit(None).cast("double"),
            "jockey_top3_rate": F.lit(None).cast("double"),
            "jockey_experience": F.lit(None).cast("long"),
        })
    return rolling(df, [key], order, n,
                   means={"jockey_win_rate": _win(), "jockey_top3_rate": _top3()},
                   count_name="jockey_experience", base=base)


def add_targets(df: DataFrame) -> DataFrame:
    """``is_win`` (0/1 long) and ``actual_position``."""
    return df.withColumns({
        "is_win": (F.col("finish_position") == 1).cast("long"),
        "actual_position": F.col("finish_position"),
    })


def prepare_for_training(raw: DataFrame, order: Sequence[str], n: int = N_PAST) -> DataFrame:
    """Drop rows without an outcome, add horse and jockey history and targets."""
    df = raw.filter(F.col("finish_position").isNotNull())                      # D1
    if "age" in df.columns and "horse_age" not in df.columns:                  # D13
        df = df.withColumnRenamed("age", "horse_age")
    return add_targets(jockey_history(horse_history(df, order, n), order, n, base=df))


def strict_date_history(df: DataFrame, order: Sequence[str], n: int = N_PAST,
                        key: str = "horse_id") -> DataFrame:
    """Q1 option: history from earlier *dates* only.

    Rows of one entity on one date share the history of the first of them,
    whose n-row frame ends exactly before that date. The first row's values
    are picked per (entity, date) with ``min_by`` (partial aggregate) and
    joined back.
    """
    h = horse_history(df, order, n, key=key)
    feats = ["avg_finish", "win_rate", "top3_rate", "days_since_last_race", "num_past_races"]
    rank = F.struct(*[F.col(c) for c in order])
    first = h.groupBy(key, "race_date").agg(
        *[F.min_by(F.col(c), rank).alias(c) for c in feats])
    first = first.withColumnsRenamed({key: "_key", "race_date": "_date"})
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col("race_date").eqNullSafe(F.col("_date"))
    return df.join(first, same, "left").drop("_key", "_date")


def horse_summary(df: DataFrame, order: Sequence[str], n_past: int = N_PAST,
                  key: str = "horse_id") -> DataFrame:
    """Per-entity summary of its latest ``n_past`` races.

    ``weight`` is the value of the oldest of those races (the reference takes
    the last row after a newest-first sort).
    """
    # rows beyond the limit go before the shuffle, in every input partition, so a hot key stays small
    newest = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    recent = df.withColumn("_age", F.row_number().over(newest)).filter(F.col("_age") <= n_past)
    fp = F.col("finish_position")
    return recent.groupBy(key).agg(
        F.avg(fp.cast("double")).alias("avg_finish"),
        F.avg(F.when(fp.isNotNull(), _win())).alias("win_rate"),
        F.avg(F.when(fp.isNotNull(), _top3())).alias("top3_rate"),
        F.max("race_date").alias("last_race_date"),
        F.max_by("weight", "_age").alias("weight"),
        F.count(fp).cast("long").alias("num_past_races"),
    )


def jockey_summary(df: DataFrame, course: str | None = None, key: str = "jockey_id") -> DataFrame:
    """E2 + E3: win and top-3 rate, distinct races and the win rate on one course.

    The course rate is a conditional mean in the same aggregate (null when the
    jockey never rode that course), so no second pass or join is needed.
    """
    fp = F.col("finish_position")
    aggs = [
        F.avg(F.when(fp.isNotNull(), _win())).alias("jockey_win_rate"),
        F.avg(F.when(fp.isNotNull(), _top3())).alias("jockey_top3_rate"),
        F.countDistinct("race_id").cast("long").alias("jockey_experience"),
    ]
    if course is None:
        aggs.append(F.lit(None).cast("double").alias("jockey_course_win_rate"))
    else:
        aggs.append(F.avg(F.when((F.col("course") == course) & fp.isNotNull(), _win()))
                    .alias("jockey_course_win_rate"))
    return df.groupBy(key).agg(*aggs)


def jockey_course_rates(df: DataFrame, key: str = "jockey_id") -> DataFrame:
    """E3 generalised to every course: win rate per (jockey, course)."""
    fp = F.col("finish_position")
    return (df.filter(fp.isNotNull()).groupBy(key, "course")
              .agg(F.avg(_win()).alias("jockey_course_win_rate"),
                   F.count(F.lit(1)).cast("long").alias("rides")))


def days_since(col: str | Column, as_of: dt.date) -> Column:
    """Whole days from ``col`` to the as-of date (an argument, not today)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.datediff(F.lit(as_of), c).cast("long")
