"""Normalised views of the denormalised results frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.operators.quality import summary

# Column lists of the three normalised views.
RACE_COLUMNS = ["race_id", "race_date", "race_name", "race_number", "course", "distance",
                "track_type", "track_condition", "weather", "grade"]
HORSE_RESULT_COLUMNS = ["horse_id", "race_id", "race_date", "course", "distance",
                        "track_condition", "finish_position", "time", "weight", "jockey_id"]
EXTENDED_HORSE_RESULT_COLUMNS = HORSE_RESULT_COLUMNS + [
    "bracket_number", "post_position", "sex", "age", "carried_weight", "win_odds", "win_favorite",
    "corner_position_1", "corner_position_2", "corner_position_3", "corner_position_4",
    "last_3f_time", "horse_weight_change", "trainer", "prize_money"]
JOCKEY_RESULT_COLUMNS = ["jockey_id", "race_id", "race_date", "course", "distance", "horse_id",
                         "finish_position"]


def race_dim(df: DataFrame) -> DataFrame:
    """One row per race with its entry count, in one aggregate.

    Race attributes are taken from the entry with the smallest
    (post_position, attributes) so the pick is deterministic (the reference
    keeps an arbitrary duplicate). Scratched entries count.
    """
    attrs = [c for c in RACE_COLUMNS if c != "race_id" and c in df.columns]
    key = ["post_position"] if "post_position" in df.columns else []
    pick = F.min(F.struct(*[F.col(c) for c in key + attrs])).alias("_r")
    g = df.groupBy("race_id").agg(pick, F.count(F.lit(1)).cast("int").alias("num_entries"))
    return g.select("race_id", *[F.col(f"_r.{c}").alias(c) for c in attrs], "num_entries")


def horse_results(df: DataFrame) -> DataFrame:
    """Projection onto the extended horse-result columns that exist."""
    return df.select(*[c for c in EXTENDED_HORSE_RESULT_COLUMNS if c in df.columns])


def jockey_results(df: DataFrame) -> DataFrame:
    """Projection onto the jockey-result columns that exist."""
    return df.select(*[c for c in JOCKEY_RESULT_COLUMNS if c in df.columns])


def import_checks(races: DataFrame, horses: DataFrame, jockeys: DataFrame,
                  max_null_rate: float = 0.5) -> DataFrame:
    """(view, rows, violations): each view is counted and checked in one aggregate.

    The required columns are the full view lists (the reference passes only
    the columns present, so its check can never fire).
    """
    views = [("races", races, RACE_COLUMNS), ("horse_results", horses, HORSE_RESULT_COLUMNS),
             ("jockey_results", jockeys, JOCKEY_RESULT_COLUMNS)]
    out = None
    for name, df, req in views:
        row = summary(df, name, req, max_null_rate).withColumnRenamed("dataset", "view")
        out = row if out is None else out.unionByName(row)
    return out


def import_summary(races: DataFrame, horses: DataFrame, jockeys: DataFrame,
                   max_null_rate: float = 0.5) -> DataFrame:
    """Rows per view and the number of its violations (view, rows, violations)."""
    return import_checks(races, horses, jockeys, max_null_rate).select(
        "view", "rows", F.size("violations").cast("long").alias("violations"))


def import_messages(races: DataFrame, horses: DataFrame, jockeys: DataFrame,
                    max_null_rate: float = 0.5) -> DataFrame:
    """The violations themselves (view, column, error_type, value, message)."""
    x = import_checks(races, horses, jockeys, max_null_rate).select("view", F.explode("violations").alias("v"))
    return x.select("view", *[F.col(f"v.{c}").alias(c) for c in ("column", "error_type", "value", "message")])
