"""Queries for landed JSON sources and sinks.

Each query first lands data derived from the tables into a fresh scratch
folder (as the collectors / earlier jobs would), then runs the operator over
it and returns what it reads back.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from paddock.functions.features import extract
from paddock.operators import ingest as I
from paddock.operators.scoring import audit
from paddock.plans.bindings import entries, with_entries, with_raw
from paddock.plans.catalog import query, r6
from paddock.plans.q_history import TRAIN_SQL, training
from paddock.plans.q_ingest import NORM_SQL, RACE_DIM_SQL, normalised
from paddock.plans.q_metrics import PREDS_SQL, predictions
from paddock.session import scratch_dir, staged
from paddock.sources import landing as L
from paddock.sources import sinks as K

D0, D1 = dt.date(1996, 1, 1), dt.date(1997, 12, 31)
YEAR = 1998


RACE_FLAT_SQL = """
, head AS (SELECT * FROM entries WHERE finish_position = 1),
cnt AS (SELECT race_id, count(*) AS n FROM entries GROUP BY race_id)
SELECT CAST(h.race_id AS VARCHAR) AS race_id, h.race_date,
       COALESCE(CASE WHEN h.race_id % 7 <> 0 THEN 'R' || CAST(h.race_id AS VARCHAR) END, '') AS race_name,
       COALESCE(h.course, '') AS course, CAST(h.race_id % 12 + 1 AS INTEGER) AS race_number,
       COALESCE(CASE WHEN h.race_id % 11 <> 0 THEN h.distance END, 0) AS distance,
       COALESCE(h.track_type, '') AS track_type, COALESCE(h.track_condition, '') AS track_condition,
       COALESCE(h.weather, '') AS weather, COALESCE(h.grade, '') AS grade,
       CAST(CASE WHEN h.race_id % 53 = 0 THEN 0 ELSE c.n END AS INTEGER) AS num_entries
FROM head h JOIN cnt c USING (race_id)
WHERE h.race_id % 89 <> 0"""


@query("json_race_flatten", with_entries(RACE_FLAT_SQL + f" AND h.race_date BETWEEN DATE '{D0}' AND DATE '{D1}'"))
def q_json_race_flatten(spark, sf):
    """A6 + A7: landed race JSON over a date range -> flat race rows with defaults."""
    path = scratch_dir(spark, "races-json")
    L.land_races(entries(spark, sf), path)
    return L.read_races(spark, path, D0, D1)


@query("per_entity_latest", with_entries("""
, r AS (SELECT *, row_number() OVER (PARTITION BY horse_id ORDER BY race_date DESC, CAST(race_id AS VARCHAR) DESC,
        ln DESC, finish_position) AS k FROM entries)
SELECT CAST(horse_id AS VARCHAR) AS horse_id, CAST(race_id AS VARCHAR) AS race_id, race_date, finish_position,
       CAST(ln AS INTEGER) AS ln FROM r WHERE k <= 10"""))
def q_per_entity_latest(spark, sf):
    """Horse pages flattened, at most 10 latest results per horse."""
    path = scratch_dir(spark, "horse-pages")
    L.land_pages(entries(spark, sf), path, "horse_id")
    return L.horse_results(spark, path, limit=10).select("horse_id", "race_id", "race_date", "finish_position", "ln")


@query("semi_join_flatten", with_entries(f"""
SELECT CAST(jockey_id AS VARCHAR) AS jockey_id, CAST(race_id AS VARCHAR) AS race_id, race_date, finish_position,
       CAST(horse_id AS VARCHAR) AS horse_id, CAST(ln AS INTEGER) AS ln
FROM entries WHERE year(race_date) = {YEAR}
  AND jockey_id IN (SELECT jockey_id FROM entries WHERE race_date BETWEEN DATE '{D0}' AND DATE '{D1}')"""))
def q_semi_join_flatten(spark, sf):
    """Jockey pages of the jockeys riding in the collected races, one year only."""
    e = entries(spark, sf)
    path = scratch_dir(spark, "jockey-pages")
    L.land_pages(e, path, "jockey_id")
    req = e.filter(F.col("race_date").between(F.lit(D0), F.lit(D1))).select(F.col("jockey_id").cast("string"))
    j = L.jockey_results(spark, path, req, year=YEAR)
    return j.select("jockey_id", "race_id", "race_date", "finish_position", "horse_id", "ln")


@query("partitioned_write", with_raw(NORM_SQL + f"""
SELECT race_id, horse_id, finish_position, race_date FROM norm
WHERE race_date >= DATE '{D0}' AND race_date <= DATE '{D1}'"""))
def q_partitioned_write(spark, sf):
    """A10 + A11: one write partitioned by date; the date-range read prunes partitions."""
    path = scratch_dir(spark, "results-by-date")
    K.write_partitioned(normalised(spark, sf), path, ["race_date"], mode="overwrite")
    back = spark.read.parquet(path).filter(F.col("race_date").between(F.lit(D0), F.lit(D1)))
    return back.select("race_id", "horse_id", "finish_position", "race_date")


@query("write_modes", with_raw(NORM_SQL + RACE_DIM_SQL + """
SELECT race_id, race_date, num_entries, true AS exists, true AS empty_rejected FROM rd
WHERE k = 1"""))
def q_write_modes(spark, sf):
    """A12 + A16: TRUNCATE then APPEND, EMPTY refused on a filled table."""
    races = I.race_dim(normalised(spark, sf))
    path = scratch_dir(spark, "races-table")
    half = F.pmod(F.xxhash64("race_id"), F.lit(2))            # all races, in two halves
    K.write_table(races.filter(half == 0), path, "TRUNCATE")
    K.write_table(races.filter(half == 1), path, "APPEND")
    try:
        K.write_table(races, path, "EMPTY")
        rejected = False
    except ValueError:
        rejected = True
    back = spark.read.parquet(path)
    return back.select("race_id", "race_date", "num_entries", F.lit(K.table_exists(spark, path)).alias("exists"),
                       F.lit(rejected).alias("empty_rejected"))


@query("year_import", with_raw(NORM_SQL + """
SELECT CAST(year(race_date) AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS rows FROM norm
WHERE year(race_date) IS DISTINCT FROM 1997 GROUP BY 1
UNION ALL SELECT 1997, CAST(count(*) AS BIGINT) FROM norm WHERE year(race_date) = 1997 AND finish_position = 1"""))
def q_year_import(spark, sf):
    """Year-partitioned import; re-importing 1997 replaces only that year."""
    n = normalised(spark, sf)
    path = scratch_dir(spark, "results-by-year")
    K.import_by_year(n, path)
    K.import_by_year(n.filter((F.year("race_date") == 1997) & (F.col("finish_position") == 1)), path)
    back = spark.read.parquet(path)
    return back.groupBy(F.col("year").cast("int").alias("year")).agg(F.count(F.lit(1)).cast("long").alias("rows"))


@query("feature_store_load", with_entries(TRAIN_SQL + """
SELECT race_id, horse_id, CAST(ln AS BIGINT) AS ln, round(avg_finish, 6) AS feat_avg_finish FROM train
WHERE race_id IN (SELECT race_id FROM entries WHERE year(race_date) = 1997)"""))
def q_feature_store_load(spark, sf):
    """A14 + A15: save the feature table by date, load columns for a set of races."""
    f = extract(training(spark, sf), ["horse"]).select(
        "race_id", "horse_id", F.col("ln").cast("long").alias("ln"), "race_date", "feat_avg_finish", "feat_win_odds")
    path = scratch_dir(spark, "features")
    K.save_features(f, path, mode="truncate")
    ids = entries(spark, sf).filter(F.year("race_date") == 1997).select("race_id")
    back = K.load_features(spark, path, ["race_id", "horse_id", "ln", "feat_avg_finish"], ids)
    return back.select("race_id", "horse_id", "ln", r6("feat_avg_finish").alias("feat_avg_finish"))


FEATURE_BUCKETS = 16


@query("feature_table_join", with_entries(TRAIN_SQL + """
SELECT race_id, count(*) AS n_entries, round(avg(round(avg_finish, 6)), 6) AS mean_finish,
       CAST(sum(CASE WHEN finish_position = 1 THEN 1 ELSE 0 END) AS BIGINT) AS winners
FROM train WHERE race_id IN (SELECT race_id FROM entries WHERE year(race_date) = 1997) GROUP BY race_id"""))
def q_feature_table_join(spark, sf):
    """A14 + A15, clustered: features and results in tables bucketed by race, a year's
    races reduced and joined by race without another shuffle of either table."""
    ids = ["race_id", "horse_id", "ln"]
    # both tables come from one written frame, which holds the columns of the two and no more
    t = staged(extract(training(spark, sf), ["horse"]).select(*ids, "race_date", "finish_position", "feat_avg_finish"), "feature-table")
    tag = uuid.uuid4().hex[:12]
    names = [f"features_{tag}", f"results_{tag}"]
    parts = [t.select(*ids, F.round("feat_avg_finish", 6).alias("feat_avg_finish")), t.select(*ids, "race_date", "finish_position")]
    for name, part in zip(names, parts, strict=True):
        K.save_feature_table(part, name, scratch_dir(spark, name), buckets=FEATURE_BUCKETS)
    f, r = (K.load_feature_table(spark, n) for n in names)
    means = f.groupBy("race_id").agg(F.count(F.lit(1)).alias("n_entries"), r6(F.avg("feat_avg_finish")).alias("mean_finish"))
    won = r.filter(F.year("race_date") == 1997).groupBy("race_id").agg(
        F.sum(F.when(F.col("finish_position") == 1, 1).otherwise(0)).cast("long").alias("winners"))
    return means.join(won, "race_id")


@query("prediction_sink", with_entries(PREDS_SQL + """
SELECT race_id, horse_id, round(predicted_prob, 6) AS win_probability, race_date AS predicted_date,
       'deterministic' AS model_name FROM preds"""))
def q_prediction_sink(spark, sf):
    """Append predictions to the table and a JSON dump by date; read the dump back."""
    p = audit(predictions(spark, sf), "deterministic").select(
        "race_id", "horse_id", F.col("predicted_prob").alias("win_probability"),
        F.col("race_date").alias("predicted_date"), "model_name")
    table, dump = scratch_dir(spark, "pred-table"), scratch_dir(spark, "pred-json")
    K.sink_predictions(p, table, dump)
    back = spark.read.schema("race_id long, horse_id long, win_probability double, model_name string, "
                             "predicted_date date").json(dump)
    return back.select("race_id", "horse_id", r6("win_probability").alias("win_probability"), "predicted_date",
                       "model_name")


@query("stream_landed_races", with_entries(RACE_FLAT_SQL))
def q_stream_landed_races(spark, sf):
    """A7 as an incremental job: a file stream over the landing folder stores
    race records; re-running it picks up nothing twice."""
    from paddock.streaming.landing import ingest_landed_races, landed_races
    land, table, ckpt = scratch_dir(spark, "landing"), scratch_dir(spark, "races-stream"), scratch_dir(spark, "ckpt")
    L.land_races(entries(spark, sf), land)
    ingest_landed_races(spark, land, table, ckpt).awaitTermination()
    ingest_landed_races(spark, land, table, ckpt).awaitTermination()      # nothing new: no duplicates
    return landed_races(spark, table)
