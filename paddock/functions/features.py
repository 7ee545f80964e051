"""Stateless feature columns.

Each extractor is a function ``DataFrame -> dict[name, Column]`` that looks at
the frame's columns at plan time (no job) and returns one expression per
feature, falling back to a literal when its input column is absent. All
chosen extractors are applied in ONE ``select``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Category codes.
TRACK_CONDITION_MAP = {"良": 0, "稍重": 1, "重": 2, "不良": 3}
WEATHER_MAP = {"晴": 0, "曇": 1, "小雨": 2, "雨": 3, "雪": 4}
TRACK_TYPE_MAP = {"芝": 0, "ダート": 1, "障害": 2}
# Gelding is written two ways; both map to 2 (the reference's map only has the first).
SEX_MAP = {"牡": 0, "牝": 1, "騸": 2, "セ": 2}


def lookup(col: Column, mapping: dict, default: int = -1) -> Column:
    """Map lookup with a default for unknown and null values."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, col.cast("string")), F.lit(default)).cast("long")


def _has(df: DataFrame, c: str) -> bool:
    return c in df.columns


def _cast_or(df: DataFrame, src: str, t: str, absent) -> Column:
    if _has(df, src):
        return F.col(src).cast(t)
    return F.lit(absent).cast(t) if absent is not None else F.lit(None).cast(t)


def race_features(df: DataFrame) -> dict[str, Column]:
    """F1-F6."""
    return {
        "feat_distance": _cast_or(df, "distance", "long", 0),
        "feat_track_condition": lookup(F.col("track_condition"), TRACK_CONDITION_MAP)
        if _has(df, "track_condition") else F.lit(-1).cast("long"),
        "feat_weather": lookup(F.col("weather"), WEATHER_MAP)
        if _has(df, "weather") else F.lit(-1).cast("long"),
        "feat_track_type": lookup(F.col("track_type"), TRACK_TYPE_MAP)
        if _has(df, "track_type") else F.lit(-1).cast("long"),
        "feat_num_entries": _cast_or(df, "num_entries", "long", 0),
        "feat_is_grade_race": ((F.col("grade").isNotNull() & (F.col("grade") != "")).cast("long")
                               if _has(df, "grade") else F.lit(0).cast("long")),
    }


def horse_features(df: DataFrame, as_of: dt.date | None = None,
                   allow_current_result: bool = False) -> dict[str, Column]:
    """F7-F20.

    Without history columns the reference falls back to the row's own finish
    position, which leaks the target; that fallback is opt-in here
    (``allow_current_result``), otherwise the feature is null.
    """
    fp = F.col("finish_position") if _has(df, "finish_position") else None

    def hist(name: str, leak: Callable[[Column], Column]) -> Column:
        if _has(df, name):
            return F.col(name).cast("double")
        if allow_current_result and fp is not None:
            return leak(fp).cast("double")
        return F.lit(None).cast("double")

    if _has(df, "days_since_last_race"):
        days = F.col("days_since_last_race").cast("long")
    elif _has(df, "last_race_date") and as_of is not None:
        days = F.datediff(F.lit(as_of), F.col("last_race_date")).cast("long")
    else:
        days = F.lit(None).cast("long")
    return {
        "feat_avg_finish": hist("avg_finish", lambda c: c),
        "feat_win_rate": hist("win_rate", lambda c: (c == 1)),
        "feat_top3_rate": hist("top3_rate", lambda c: (c <= 3)),
        "feat_days_since_last_race": days,
        "feat_horse_age": _cast_or(df, "horse_age", "long", None),
        "feat_horse_weight": _cast_or(df, "weight", "double", None),
        "feat_num_past_races": _cast_or(df, "num_past_races", "long", None),
        "feat_win_odds": _cast_or(df, "win_odds", "double", None),
        "feat_win_favorite": _cast_or(df, "win_favorite", "long", None),
        "feat_bracket_number": _cast_or(df, "bracket_number", "long", None),
        "feat_post_position": _cast_or(df, "post_position", "long", None),
        "feat_carried_weight": _cast_or(df, "carried_weight", "double", None),
        "feat_sex": lookup(F.col("sex"), SEX_MAP) if _has(df, "sex") else F.lit(None).cast("long"),
        "feat_horse_weight_change": _cast_or(df, "horse_weight_change", "double", None),
    }


def jockey_features(df: DataFrame) -> dict[str, Column]:
    """F21-F24."""
    return {
        "feat_jockey_win_rate": _cast_or(df, "jockey_win_rate", "double", None),
        "feat_jockey_top3_rate": _cast_or(df, "jockey_top3_rate", "double", None),
        "feat_jockey_course_win_rate": _cast_or(df, "jockey_course_win_rate", "double", None),
        "feat_jockey_experience": _cast_or(df, "jockey_experience", "long", None),
    }


def style_features(df: DataFrame) -> dict[str, Column]:
    """F25-F26."""
    return {
        "feat_avg_corner_pos_4": _cast_or(df, "avg_corner_pos_4", "double", None),
        "feat_avg_last_3f_time": _cast_or(df, "avg_last_3f_time", "double", None),
    }


EXTRACTORS: dict[str, Callable[..., dict[str, Column]]] = {
    "race": race_features,
    "horse": horse_features,
    "jockey": jockey_features,
    "running_style": style_features,
}


def extract(df: DataFrame, names: Sequence[str] = ("race", "horse", "jockey", "running_style"),
            **options) -> DataFrame:
    """apply the named extractors in one projection; unknown name -> error."""
    cols: dict[str, Column] = {}
    for n in names:
        if n not in EXTRACTORS:
            raise ValueError(f"unknown extractor {n!r}; known: {sorted(EXTRACTORS)}")
        fn = EXTRACTORS[n]
        cols.update(fn(df, **options) if n == "horse" else fn(df))
    return df.withColumns(cols)


def feature_columns(df: DataFrame) -> list[str]:
    """model inputs are the ``feat_`` columns."""
    return [c for c in df.columns if c.startswith("feat_")]


def select_features(df: DataFrame) -> DataFrame:
    return df.select(*feature_columns(df))
