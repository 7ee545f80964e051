"""Queries for history features (D1-D14, Q1) and entity summaries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from paddock.operators import history as H
from paddock.plans.bindings import HISTORY_ORDER, HISTORY_ORDER_SQL as ORD, described, entries, entry_columns, runners, with_entries
from paddock.plans.catalog import query, r6

AS_OF = dt.date(2001, 9, 1)
COURSE = "1-URGENT"


def training(spark, sf, source=None):
    """D14 over the entries, whose further columns are made after the histories' shuffles.
    ``source``: the rows of ``runners`` where a job has written them, since the histories
    refer to them several times; its further columns stay."""
    own = entry_columns("corner_position_4", "last_3f_time")
    rows = runners(spark, sf) if source is None else source
    h = H.prepare_for_training(rows.withColumns(own), HISTORY_ORDER)
    return described(h.drop(*own), rename={"age": "horse_age"})


def _ids(df):
    return [F.col(c).cast("long").alias(c) if c in ("race_id", "horse_id", "jockey_id", "ln") else c
            for c in ("race_id", "horse_id", "jockey_id", "race_date", "ln")]


@query("horse_history", with_entries(f"""
SELECT race_id, horse_id, jockey_id, race_date, CAST(ln AS BIGINT) AS ln,
       CAST(finish_position AS BIGINT) AS finish_position,
       round(avg(CAST(finish_position AS DOUBLE)) OVER w, 6) AS avg_finish,
       round(avg(CASE WHEN finish_position = 1 THEN 1.0e0 ELSE 0.0e0 END) OVER w, 6) AS win_rate,
       round(avg(CASE WHEN finish_position <= 3 THEN 1.0e0 ELSE 0.0e0 END) OVER w, 6) AS top3_rate,
       round(avg(CAST(corner_position_4 AS DOUBLE)) OVER w, 6) AS avg_corner_pos_4,
       round(avg(last_3f_time) OVER w, 6) AS avg_last_3f_time,
       CAST(date_diff('day', lag(race_date) OVER o, race_date) AS BIGINT) AS days_since_last_race,
       CAST(row_number() OVER o - 1 AS BIGINT) AS num_past_races
FROM entries WHERE finish_position IS NOT NULL
WINDOW o AS (PARTITION BY horse_id ORDER BY {ORD}),
       w AS (PARTITION BY horse_id ORDER BY {ORD} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
"""))
def q_horse_history(spark, sf):
    e = entries(spark, sf).filter(F.col("finish_position").isNotNull())
    h = H.horse_history(e, HISTORY_ORDER)
    return h.select(*_ids(h), F.col("finish_position").cast("long").alias("finish_position"),
                    *[r6(c).alias(c) for c in ("avg_finish", "win_rate", "top3_rate",
                                               "avg_corner_pos_4", "avg_last_3f_time")],
                    "days_since_last_race", "num_past_races")


@query("jockey_history", with_entries(f"""
SELECT race_id, horse_id, jockey_id, race_date, CAST(ln AS BIGINT) AS ln,
       round(avg(CASE WHEN finish_position = 1 THEN 1.0e0 ELSE 0.0e0 END) OVER w, 6) AS jockey_win_rate,
       round(avg(CASE WHEN finish_position <= 3 THEN 1.0e0 ELSE 0.0e0 END) OVER w, 6) AS jockey_top3_rate,
       CAST(row_number() OVER o - 1 AS BIGINT) AS jockey_experience
FROM entries WHERE finish_position IS NOT NULL
WINDOW o AS (PARTITION BY jockey_id ORDER BY {ORD}),
       w AS (PARTITION BY jockey_id ORDER BY {ORD} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
"""))
def q_jockey_history(spark, sf):
    e = entries(spark, sf).filter(F.col("finish_position").isNotNull())
    h = H.jockey_history(e, HISTORY_ORDER)
    return h.select(*_ids(h), r6("jockey_win_rate").alias("jockey_win_rate"),
                    r6("jockey_top3_rate").alias("jockey_top3_rate"), "jockey_experience")


@query("targets", with_entries("""
SELECT race_id, horse_id, CAST(ln AS BIGINT) AS ln,
       CAST(finish_position = 1 AS BIGINT) AS is_win,
       CAST(finish_position AS BIGINT) AS actual_position
FROM entries WHERE finish_position IS NOT NULL
"""))
def q_targets(spark, sf):
    e = H.add_targets(entries(spark, sf).filter(F.col("finish_position").isNotNull()))
    return e.select(F.col("race_id").cast("long"), F.col("horse_id").cast("long"),
                    F.col("ln").cast("long"), "is_win",
                    F.col("actual_position").cast("long").alias("actual_position"))


TRAINING_SQL = with_entries(f"""
SELECT race_id, horse_id, jockey_id, race_date, CAST(ln AS BIGINT) AS ln,
       CAST(age AS BIGINT) AS horse_age,
       round(avg(CAST(finish_position AS DOUBLE)) OVER hw, 6) AS avg_finish,
       round(avg(CASE WHEN finish_position = 1 THEN 1.0e0 ELSE 0.0e0 END) OVER hw, 6) AS win_rate,
       round(avg(CASE WHEN finish_position <= 3 THEN 1.0e0 ELSE 0.0e0 END) OVER hw, 6) AS top3_rate,
       CAST(date_diff('day', lag(race_date) OVER ho, race_date) AS BIGINT) AS days_since_last_race,
       CAST(row_number() OVER ho - 1 AS BIGINT) AS num_past_races,
       round(avg(CASE WHEN finish_position = 1 THEN 1.0e0 ELSE 0.0e0 END) OVER jw, 6) AS jockey_win_rate,
       round(avg(CASE WHEN finish_position <= 3 THEN 1.0e0 ELSE 0.0e0 END) OVER jw, 6) AS jockey_top3_rate,
       CAST(row_number() OVER jo - 1 AS BIGINT) AS jockey_experience,
       CAST(finish_position = 1 AS BIGINT) AS is_win,
       CAST(finish_position AS BIGINT) AS actual_position
FROM entries WHERE finish_position IS NOT NULL
WINDOW ho AS (PARTITION BY horse_id ORDER BY {ORD}),
       hw AS (PARTITION BY horse_id ORDER BY {ORD} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING),
       jo AS (PARTITION BY jockey_id ORDER BY {ORD}),
       jw AS (PARTITION BY jockey_id ORDER BY {ORD} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
""")


@query("training_frame", TRAINING_SQL)
def q_training_frame(spark, sf):
    t = training(spark, sf)
    return t.select(*_ids(t), F.col("horse_age").cast("long").alias("horse_age"),
                    *[r6(c).alias(c) for c in ("avg_finish", "win_rate", "top3_rate")],
                    "days_since_last_race", "num_past_races",
                    r6("jockey_win_rate").alias("jockey_win_rate"),
                    r6("jockey_top3_rate").alias("jockey_top3_rate"), "jockey_experience",
                    "is_win", F.col("actual_position").cast("long").alias("actual_position"))


@query("horse_history_strict_date", with_entries(f"""
, h AS (
  SELECT race_id, horse_id, ln, race_date,
         avg(CAST(finish_position AS DOUBLE)) OVER w AS avg_finish,
         avg(CASE WHEN finish_position = 1 THEN 1.0e0 ELSE 0.0e0 END) OVER w AS win_rate,
         avg(CASE WHEN finish_position <= 3 THEN 1.0e0 ELSE 0.0e0 END) OVER w AS top3_rate,
         date_diff('day', lag(race_date) OVER o, race_date) AS days_since_last_race,
         row_number() OVER o - 1 AS num_past_races,
         row_number() OVER (PARTITION BY horse_id, race_date ORDER BY {ORD}) AS k
  FROM entries WHERE finish_position IS NOT NULL
  WINDOW o AS (PARTITION BY horse_id ORDER BY {ORD}),
         w AS (PARTITION BY horse_id ORDER BY {ORD} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
)
SELECT e.race_id, e.horse_id, CAST(e.ln AS BIGINT) AS ln, e.race_date,
       round(h.avg_finish, 6) AS avg_finish, round(h.win_rate, 6) AS win_rate,
       round(h.top3_rate, 6) AS top3_rate,
       CAST(h.days_since_last_race AS BIGINT) AS days_since_last_race,
       CAST(h.num_past_races AS BIGINT) AS num_past_races
FROM entries e JOIN h ON e.horse_id = h.horse_id AND e.race_date = h.race_date AND h.k = 1
WHERE e.finish_position IS NOT NULL
"""))
def q_horse_history_strict(spark, sf):
    e = entries(spark, sf).filter(F.col("finish_position").isNotNull())
    h = H.strict_date_history(e, HISTORY_ORDER)
    return h.select(F.col("race_id").cast("long"), F.col("horse_id").cast("long"),
                    F.col("ln").cast("long"), "race_date",
                    *[r6(c).alias(c) for c in ("avg_finish", "win_rate", "top3_rate")],
                    "days_since_last_race", "num_past_races")


@query("horse_summary", with_entries(f"""
, recent AS (
  SELECT *, row_number() OVER (PARTITION BY horse_id ORDER BY race_date DESC, race_id DESC, ln DESC,
            horse_id DESC, jockey_id DESC, price DESC, ship DESC) - 1 AS age_rank
  FROM entries
)
SELECT horse_id,
       round(avg(CAST(finish_position AS DOUBLE)), 6) AS avg_finish,
       round(avg(CASE WHEN finish_position IS NULL THEN NULL WHEN finish_position = 1 THEN 1.0e0 ELSE 0.0e0 END), 6) AS win_rate,
       round(avg(CASE WHEN finish_position IS NULL THEN NULL WHEN finish_position <= 3 THEN 1.0e0 ELSE 0.0e0 END), 6) AS top3_rate,
       max(race_date) AS last_race_date,
       round(arg_max(weight, age_rank), 6) AS weight,
       CAST(count(finish_position) AS BIGINT) AS num_past_races,
       CAST(date_diff('day', max(race_date), DATE '{AS_OF}') AS BIGINT) AS days_since_last_race
FROM recent WHERE age_rank < 5 GROUP BY horse_id
"""))
def q_horse_summary(spark, sf):
    s = H.horse_summary(entries(spark, sf), HISTORY_ORDER)
    return s.select(F.col("horse_id").cast("long"),
                    *[r6(c).alias(c) for c in ("avg_finish", "win_rate", "top3_rate")],
                    "last_race_date", r6("weight").alias("weight"), "num_past_races",
                    H.days_since("last_race_date", AS_OF).alias("days_since_last_race"))


@query("jockey_summary", with_entries(f"""
SELECT jockey_id,
       round(avg(CASE WHEN finish_position = 1 THEN 1.0e0 WHEN finish_position IS NOT NULL THEN 0.0e0 END), 6) AS jockey_win_rate,
       round(avg(CASE WHEN finish_position <= 3 THEN 1.0e0 WHEN finish_position IS NOT NULL THEN 0.0e0 END), 6) AS jockey_top3_rate,
       CAST(count(DISTINCT race_id) AS BIGINT) AS jockey_experience,
       round(avg(CASE WHEN course = '{COURSE}' AND finish_position IS NOT NULL
                      THEN CASE WHEN finish_position = 1 THEN 1.0e0 ELSE 0.0e0 END END), 6) AS jockey_course_win_rate
FROM entries GROUP BY jockey_id
"""))
def q_jockey_summary(spark, sf):
    s = H.jockey_summary(entries(spark, sf), course=COURSE)
    return s.select(F.col("jockey_id").cast("long"),
                    *[r6(c).alias(c) for c in ("jockey_win_rate", "jockey_top3_rate")],
                    "jockey_experience", r6("jockey_course_win_rate").alias("jockey_course_win_rate"))


@query("jockey_course_rate", with_entries("""
SELECT jockey_id, course,
       round(avg(CASE WHEN finish_position = 1 THEN 1.0e0 ELSE 0.0e0 END), 6) AS jockey_course_win_rate,
       CAST(count(*) AS BIGINT) AS rides
FROM entries WHERE finish_position IS NOT NULL GROUP BY jockey_id, course
"""))
def q_jockey_course_rate(spark, sf):
    s = H.jockey_course_rates(entries(spark, sf))
    return s.select(F.col("jockey_id").cast("long"), "course",
                    r6("jockey_course_win_rate").alias("jockey_course_win_rate"), "rides")


@query("days_since_as_of", with_entries(f"""
SELECT horse_id, max(race_date) AS last_race_date,
       CAST(date_diff('day', max(race_date), DATE '{AS_OF}') AS BIGINT) AS days_since_last_race
FROM entries GROUP BY horse_id
"""))
def q_days_since(spark, sf):
    e = entries(spark, sf).groupBy("horse_id").agg(F.max("race_date").alias("last_race_date"))
    return e.select(F.col("horse_id").cast("long"), "last_race_date",
                    H.days_since("last_race_date", AS_OF).alias("days_since_last_race"))


# Full training frame (every entries column + history + targets) for the oracle.
TRAIN_SQL = f"""
, train AS (
  SELECT * EXCLUDE (age, win, top3), age AS horse_age,
         avg(CAST(finish_position AS DOUBLE)) OVER hw AS avg_finish,
         avg(win) OVER hw AS win_rate, avg(top3) OVER hw AS top3_rate,
         avg(CAST(corner_position_4 AS DOUBLE)) OVER hw AS avg_corner_pos_4,
         avg(last_3f_time) OVER hw AS avg_last_3f_time,
         date_diff('day', lag(race_date) OVER ho, race_date) AS days_since_last_race,
         row_number() OVER ho - 1 AS num_past_races,
         avg(win) OVER jw AS jockey_win_rate, avg(top3) OVER jw AS jockey_top3_rate,
         row_number() OVER jo - 1 AS jockey_experience,
         CAST(finish_position = 1 AS BIGINT) AS is_win, finish_position AS actual_position
  FROM (SELECT *, CASE WHEN finish_position = 1 THEN 1.0e0 ELSE 0.0e0 END AS win,
               CASE WHEN finish_position <= 3 THEN 1.0e0 ELSE 0.0e0 END AS top3
        FROM entries WHERE finish_position IS NOT NULL)
  WINDOW ho AS (PARTITION BY horse_id ORDER BY {ORD}),
         hw AS (PARTITION BY horse_id ORDER BY {ORD} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING),
         jo AS (PARTITION BY jockey_id ORDER BY {ORD}),
         jw AS (PARTITION BY jockey_id ORDER BY {ORD} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
)"""
