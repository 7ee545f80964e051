"""Queries for feature projections (F1-F28) and fitted encoders/scalers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from paddock.functions import features as FT
from paddock.operators.fitted import CategoryEncoder, FeaturePipeline, FeatureScaler
from paddock.plans.bindings import entries, with_entries
from paddock.plans.catalog import query, r6
from paddock.plans.q_history import TRAIN_SQL, training
from paddock.session import staged

SPLIT_DATE = dt.date(1998, 1, 1)
IDS = ["race_id", "horse_id", "ln"]


def _map_sql(col, mapping, default="-1"):
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in mapping.items())
    return f"COALESCE(CASE CAST({col} AS VARCHAR) {cases} END, {default})"


def _ids():
    return [F.col("race_id"), F.col("horse_id"), F.col("ln").cast("long").alias("ln")]


def _out(df, names, doubles=()):
    return df.select(*_ids(), *[r6(c).alias(c) if c in doubles else F.col(c) for c in names])


RACE_FEATS = ["feat_distance", "feat_track_condition", "feat_weather", "feat_track_type",
              "feat_num_entries", "feat_is_grade_race"]
RACE_SQL = f"""SELECT race_id, horse_id, CAST(ln AS BIGINT) AS ln,
  CAST(distance AS BIGINT) AS feat_distance,
  CAST({_map_sql('track_condition', FT.TRACK_CONDITION_MAP)} AS BIGINT) AS feat_track_condition,
  CAST({_map_sql('weather', FT.WEATHER_MAP)} AS BIGINT) AS feat_weather,
  CAST({_map_sql('track_type', FT.TRACK_TYPE_MAP)} AS BIGINT) AS feat_track_type,
  CAST(num_entries AS BIGINT) AS feat_num_entries,
  CAST(grade IS NOT NULL AND grade <> '' AS BIGINT) AS feat_is_grade_race"""


@query("race_features", with_entries(TRAIN_SQL + "\n" + RACE_SQL + " FROM train"))
def q_race_features(spark, sf):
    return _out(FT.extract(training(spark, sf), ["race"]), RACE_FEATS)


HORSE_DOUBLES = ["feat_avg_finish", "feat_win_rate", "feat_top3_rate", "feat_horse_weight", "feat_win_odds",
                 "feat_carried_weight", "feat_horse_weight_change"]
HORSE_FEATS = ["feat_avg_finish", "feat_win_rate", "feat_top3_rate", "feat_days_since_last_race",
               "feat_horse_age", "feat_horse_weight", "feat_num_past_races", "feat_win_odds",
               "feat_win_favorite", "feat_bracket_number", "feat_post_position", "feat_carried_weight",
               "feat_sex", "feat_horse_weight_change"]
HORSE_SQL = f"""SELECT race_id, horse_id, CAST(ln AS BIGINT) AS ln,
  round(avg_finish, 6) AS feat_avg_finish, round(win_rate, 6) AS feat_win_rate,
  round(top3_rate, 6) AS feat_top3_rate, CAST(days_since_last_race AS BIGINT) AS feat_days_since_last_race,
  CAST(horse_age AS BIGINT) AS feat_horse_age, round(weight, 6) AS feat_horse_weight,
  CAST(num_past_races AS BIGINT) AS feat_num_past_races, round(win_odds, 6) AS feat_win_odds,
  CAST(win_favorite AS BIGINT) AS feat_win_favorite, CAST(bracket_number AS BIGINT) AS feat_bracket_number,
  CAST(post_position AS BIGINT) AS feat_post_position, round(carried_weight, 6) AS feat_carried_weight,
  CAST({_map_sql('sex', FT.SEX_MAP)} AS BIGINT) AS feat_sex,
  round(horse_weight_change, 6) AS feat_horse_weight_change"""


@query("horse_features", with_entries(TRAIN_SQL + "\n" + HORSE_SQL + " FROM train"))
def q_horse_features(spark, sf):
    return _out(FT.extract(training(spark, sf), ["horse"]), HORSE_FEATS, HORSE_DOUBLES)


JOCKEY_FEATS = ["feat_jockey_win_rate", "feat_jockey_top3_rate", "feat_jockey_course_win_rate",
                "feat_jockey_experience"]
JOCKEY_SQL = """SELECT race_id, horse_id, CAST(ln AS BIGINT) AS ln,
  round(jockey_win_rate, 6) AS feat_jockey_win_rate, round(jockey_top3_rate, 6) AS feat_jockey_top3_rate,
  CAST(NULL AS DOUBLE) AS feat_jockey_course_win_rate, CAST(jockey_experience AS BIGINT) AS feat_jockey_experience"""


@query("jockey_features", with_entries(TRAIN_SQL + "\n" + JOCKEY_SQL + " FROM train"))
def q_jockey_features(spark, sf):
    return _out(FT.extract(training(spark, sf), ["jockey"]), JOCKEY_FEATS,
                ["feat_jockey_win_rate", "feat_jockey_top3_rate", "feat_jockey_course_win_rate"])


STYLE_FEATS = ["feat_avg_corner_pos_4", "feat_avg_last_3f_time"]


@query("style_features", with_entries(TRAIN_SQL + """
SELECT race_id, horse_id, CAST(ln AS BIGINT) AS ln, round(avg_corner_pos_4, 6) AS feat_avg_corner_pos_4,
       round(avg_last_3f_time, 6) AS feat_avg_last_3f_time FROM train"""))
def q_style_features(spark, sf):
    return _out(FT.extract(training(spark, sf), ["running_style"]), STYLE_FEATS, STYLE_FEATS)


ALL_FEATS = RACE_FEATS + HORSE_FEATS + JOCKEY_FEATS + STYLE_FEATS
ALL_DOUBLES = set(HORSE_DOUBLES) | {"feat_jockey_win_rate", "feat_jockey_top3_rate",
                                    "feat_jockey_course_win_rate"} | set(STYLE_FEATS)


def _feature_frame_sql():
    cols = (RACE_SQL.split("\n", 1)[1] + ",\n" + HORSE_SQL.split("\n", 1)[1] + ",\n"
            + JOCKEY_SQL.split("\n", 1)[1] + ",\n"
            + "round(avg_corner_pos_4, 6) AS feat_avg_corner_pos_4, round(avg_last_3f_time, 6) AS feat_avg_last_3f_time")
    return with_entries(TRAIN_SQL + f"\nSELECT {cols} FROM train")


@query("feature_frame", _feature_frame_sql())
def q_feature_frame(spark, sf):
    """F27 + F28: all extractors in one projection, then only the feat_ columns."""
    x = FT.select_features(FT.extract(training(spark, sf)))
    return x.select(*[r6(c).alias(c) if c in ALL_DOUBLES else F.col(c) for c in ALL_FEATS])


# -- G: fitted on rows before SPLIT_DATE, applied to every row ----------------
ENC_COLS = ["course", "weather", "track_type", "sex", "race_year"]
ONEHOT_COLS = ["weather", "track_type"]


def _enc_frame(spark, sf, extra=()):
    # read by the fit job(s) and by the transform: the narrow input is computed once
    t = training(spark, sf).withColumn("race_year", F.year("race_date").cast("string"))
    return staged(t.select("race_id", "horse_id", "ln", "race_date", *ENC_COLS, *extra), "encode")


def _train_rows(df):
    return df.filter(F.col("race_date") < F.lit(SPLIT_DATE))


ENC_SQL = f"""
, enc_src AS (SELECT *, CAST(year(race_date) AS VARCHAR) AS race_year FROM train),
""" + ",\n".join(
    f"""m_{c} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS BIGINT) AS idx
       FROM (SELECT DISTINCT {c} AS v FROM enc_src WHERE race_date < DATE '{SPLIT_DATE}' AND {c} IS NOT NULL))"""
    for c in ENC_COLS)


@query("label_encode", with_entries(TRAIN_SQL + ENC_SQL + "\nSELECT e.race_id, e.horse_id, CAST(e.ln AS BIGINT) AS ln, "
       + ", ".join(f"COALESCE(m_{c}.idx, -1) AS {c}_encoded" for c in ENC_COLS)
       + " FROM enc_src e " + " ".join(f"LEFT JOIN m_{c} ON CAST(e.{c} AS VARCHAR) = m_{c}.v" for c in ENC_COLS)))
def q_label_encode(spark, sf):
    df = _enc_frame(spark, sf)
    model = CategoryEncoder(ENC_COLS, "label").fit(_train_rows(df))
    return model.transform(df).select(*_ids(), *[f"{c}_encoded" for c in ENC_COLS])


def _onehot_values(spark, sf):
    """Distinct training values per one-hot column (the output columns depend on them)."""
    return CategoryEncoder(ONEHOT_COLS, "onehot").fit(_train_rows(_enc_frame(spark, sf)))


ONEHOT_VALUES = {"weather": sorted(FT.WEATHER_MAP), "track_type": sorted(FT.TRACK_TYPE_MAP)}


@query("onehot", with_entries(TRAIN_SQL + ENC_SQL + "\nSELECT race_id, horse_id, CAST(ln AS BIGINT) AS ln, weather, track_type, "
       + ", ".join(f'CAST(CAST({c} AS VARCHAR) = \'{v}\' AS BIGINT) AS "{c}_{v}"'
                   for c, vs in ONEHOT_VALUES.items() for v in vs) + " FROM enc_src"))
def q_onehot(spark, sf):
    df = _enc_frame(spark, sf)
    model = CategoryEncoder(ONEHOT_COLS, "onehot").fit(_train_rows(df))
    out = [f"{c}_{v}" for c, vs in model.mappings.items() for v in vs]
    return model.transform(df).select(*_ids(), *ONEHOT_COLS, *out)


SPARSE_COLS = ["horse_id", "jockey_id", "course"]


@query("onehot_sparse", with_entries(", " + ",\n".join(
    f"""s_{c} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS BIGINT) AS idx
       FROM (SELECT DISTINCT {c} AS v FROM entries WHERE race_date < DATE '{SPLIT_DATE}' AND {c} IS NOT NULL))"""
    for c in SPARSE_COLS) + "\nSELECT e.race_id, e.horse_id, CAST(e.ln AS BIGINT) AS ln, "
       + ", ".join(f"CASE WHEN e.{c} IS NOT NULL THEN (SELECT count(*) FROM s_{c}) END AS {c}_size, s_{c}.idx AS {c}_index"
                   for c in SPARSE_COLS)
       + " FROM entries e " + " ".join(f"LEFT JOIN s_{c} ON e.{c} = s_{c}.v" for c in SPARSE_COLS)))
def q_onehot_sparse(spark, sf):
    """G2 for columns of very many values: every horse and jockey is a category."""
    df = staged(entries(spark, sf).select(*dict.fromkeys(["race_id", "horse_id", "ln", "race_date", *SPARSE_COLS])), "encode-sparse")
    x = CategoryEncoder(SPARSE_COLS, "sparse").fit(_train_rows(df)).transform(df)
    return x.select(*_ids(), *[e for c in SPARSE_COLS for e in (
        F.col(f"{c}_onehot.size").cast("long").alias(f"{c}_size"),
        F.get(F.col(f"{c}_onehot.indices"), 0).cast("long").alias(f"{c}_index"))])


SCALE_COLS = ["avg_finish", "win_odds", "carried_weight", "distance", "jockey_win_rate"]


def _stats_sql(kind):
    parts = []
    for c in SCALE_COLS:
        if kind == "standard":
            parts.append(f"""
  COALESCE(avg(CAST({c} AS DOUBLE)), 0.0) AS m_{c},
  CASE WHEN stddev_samp(CAST({c} AS DOUBLE)) IS NULL OR stddev_samp(CAST({c} AS DOUBLE)) = 0 THEN 1.0
       ELSE stddev_samp(CAST({c} AS DOUBLE)) END AS s_{c}""")
        else:
            parts.append(f"""
  COALESCE(min(CAST({c} AS DOUBLE)), 0.0) AS lo_{c}, COALESCE(max(CAST({c} AS DOUBLE)), 1.0) AS hi0_{c}""")
    return ", ".join(parts)


def _scale_sql(kind):
    if kind == "standard":
        exprs = ", ".join(f"round((CAST(t.{c} AS DOUBLE) - st.m_{c}) / st.s_{c}, 6) AS {c}_scaled" for c in SCALE_COLS)
    else:
        exprs = ", ".join(
            f"round((CAST(t.{c} AS DOUBLE) - st.lo_{c}) / (CASE WHEN st.hi0_{c} = st.lo_{c} THEN st.lo_{c} + 1.0 "
            f"ELSE st.hi0_{c} END - st.lo_{c}), 6) AS {c}_scaled" for c in SCALE_COLS)
    return with_entries(TRAIN_SQL + f"""
, st AS (SELECT {_stats_sql(kind)} FROM train WHERE race_date < DATE '{SPLIT_DATE}')
SELECT t.race_id, t.horse_id, CAST(t.ln AS BIGINT) AS ln, {exprs} FROM train t, st""")


def _scaled(spark, sf, kind):
    df = staged(training(spark, sf).select("race_id", "horse_id", "ln", "race_date", *SCALE_COLS), "scale")
    model = FeatureScaler(SCALE_COLS, kind).fit(_train_rows(df))
    return model.transform(df).select(*_ids(), *[r6(f"{c}_scaled").alias(f"{c}_scaled") for c in SCALE_COLS])


@query("standard_scale", _scale_sql("standard"))
def q_standard_scale(spark, sf):
    return _scaled(spark, sf, "standard")


@query("minmax_scale", _scale_sql("minmax"))
def q_minmax_scale(spark, sf):
    return _scaled(spark, sf, "minmax")


@query("fit_on_train_only", with_entries(TRAIN_SQL + ENC_SQL + f"""
, st AS (
  SELECT COALESCE(avg(avg_finish), 0.0) AS m_feat_avg_finish,
         CASE WHEN stddev_samp(avg_finish) IS NULL OR stddev_samp(avg_finish) = 0 THEN 1.0
              ELSE stddev_samp(avg_finish) END AS s_feat_avg_finish,
         COALESCE(avg(win_odds), 0.0) AS m_feat_win_odds,
         CASE WHEN stddev_samp(win_odds) IS NULL OR stddev_samp(win_odds) = 0 THEN 1.0
              ELSE stddev_samp(win_odds) END AS s_feat_win_odds
  FROM train WHERE race_date < DATE '{SPLIT_DATE}')
SELECT e.race_id, e.horse_id, CAST(e.ln AS BIGINT) AS ln, COALESCE(m_course.idx, -1) AS course_encoded,
       round((e.avg_finish - st.m_feat_avg_finish) / st.s_feat_avg_finish, 6) AS feat_avg_finish_scaled,
       round((e.win_odds - st.m_feat_win_odds) / st.s_feat_win_odds, 6) AS feat_win_odds_scaled
FROM enc_src e LEFT JOIN m_course ON e.course = m_course.v, st
WHERE e.race_date >= DATE '{SPLIT_DATE}'"""))
def q_fit_on_train_only(spark, sf):
    """Extract -> fit encoder -> encode -> fit scaler on training rows only;
    the fitted pipeline is applied to the later (test) rows."""
    df = _enc_frame(spark, sf, extra=("avg_finish", "win_odds"))
    pipe = FeaturePipeline(["race", "horse"], CategoryEncoder(["course"], "label"),
                           FeatureScaler(["feat_avg_finish", "feat_win_odds"], "standard"))
    model = pipe.fit(_train_rows(df))
    out = model.transform(df.filter(F.col("race_date") >= F.lit(SPLIT_DATE)))
    return out.select(*_ids(), "course_encoded", r6("feat_avg_finish_scaled").alias("feat_avg_finish_scaled"),
                      r6("feat_win_odds_scaled").alias("feat_win_odds_scaled"))
