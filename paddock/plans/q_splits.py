"""Queries for splits, walk-forward periods and backtest tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from paddock.operators import metrics as M
from paddock.operators import splits as S
from paddock.operators.backtest import predicted_rank
from paddock.plans.bindings import HISTORY_ORDER, HISTORY_ORDER_SQL as ORD, entries, with_entries
from paddock.plans.catalog import query, r6
from paddock.plans.q_metrics import PREDS_SQL, TIE, metrics_all_sql, predictions

TRAIN_W, TEST_W, STEP = 365, 30, 30
RATIO = 0.2
K_FOLDS = 5


def _ids():
    return [F.col("race_id"), F.col("horse_id"), F.col("ln").cast("long").alias("ln")]


@query("temporal_split", with_entries(f"""
, pos AS (SELECT *, row_number() OVER (ORDER BY {ORD}) AS rn, count(*) OVER () AS n FROM entries)
SELECT race_id, horse_id, CAST(ln AS BIGINT) AS ln,
       CASE WHEN rn <= floor(n * {1 - RATIO}) THEN 'train' ELSE 'validation' END AS split FROM pos"""))
def q_temporal_split(spark, sf):
    e = entries(spark, sf)
    return S.temporal_split(e, HISTORY_ORDER, RATIO).select(*_ids(), "split")


@query("temporal_split_by_date", with_entries(f"""
, h AS (SELECT race_date, count(*) AS n FROM entries GROUP BY race_date),
hc AS (SELECT *, COALESCE(sum(n) OVER (ORDER BY race_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb,
              sum(n) OVER () AS tot FROM h)
SELECT e.race_id, e.horse_id, CAST(e.ln AS BIGINT) AS ln,
       CASE WHEN hc.nb + hc.n <= floor(hc.tot * {1 - RATIO}) THEN 'train' ELSE 'validation' END AS split
FROM entries e JOIN hc USING (race_date)"""))
def q_temporal_split_by_date(spark, sf):
    """Q9 option: the same split that never cuts a day in two."""
    e = entries(spark, sf)
    return S.temporal_split(e, HISTORY_ORDER, RATIO, mode="date").select(*_ids(), "split")


@query("time_folds", with_entries(f"""
, pos AS (SELECT *, row_number() OVER (ORDER BY {ORD}) - 1 AS p, count(*) OVER () AS n FROM entries),
f AS (SELECT *, n // {K_FOLDS + 1} AS size, n - {K_FOLDS} * (n // {K_FOLDS + 1}) AS first FROM pos)
SELECT race_id, horse_id, CAST(ln AS BIGINT) AS ln, CAST(p AS BIGINT) AS position,
       CAST(CASE WHEN size > 0 AND p >= first THEN floor((p - first) / size) END AS BIGINT) AS test_fold FROM f"""))
def q_time_folds(spark, sf):
    e = entries(spark, sf)
    return S.time_folds(e, HISTORY_ORDER, K_FOLDS).select(*_ids(), "position", "test_fold")


PERIODS_SQL = f"""
, rng AS (SELECT min(race_date) AS lo, max(race_date) AS hi FROM entries),
cand AS (
  SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP) + INTERVAL {TRAIN_W} DAY, CAST(hi AS TIMESTAMP),
         INTERVAL {STEP} DAY)) AS DATE) AS test_start FROM rng
), cand2 AS (
  SELECT CAST(test_start - INTERVAL {TRAIN_W} DAY AS DATE) AS train_start,
         CAST(test_start - INTERVAL 1 DAY AS DATE) AS train_end, test_start,
         CAST(test_start + INTERVAL {TEST_W - 1} DAY AS DATE) AS test_end FROM cand
), cnt AS (
  SELECT c.*, (SELECT count(*) FROM entries e WHERE e.race_date >= c.train_start AND e.race_date < c.test_start) AS n_train,
         (SELECT count(*) FROM entries e WHERE e.race_date >= c.test_start AND e.race_date <= c.test_end) AS n_test
  FROM cand2 c
), periods AS (
  SELECT CAST(row_number() OVER (ORDER BY test_start) - 1 AS BIGINT) AS period, train_start, train_end,
         test_start, test_end, CAST(n_train AS BIGINT) AS n_train, CAST(n_test AS BIGINT) AS n_test
  FROM cnt WHERE n_train > 0 AND n_test > 0
)"""


def periods(spark, sf):
    return S.walk_forward_periods(entries(spark, sf), TRAIN_W, TEST_W, STEP)


@query("walk_forward_periods", with_entries(PERIODS_SQL + "\nSELECT period, train_start, train_end, test_start, test_end FROM periods"))
def q_walk_forward_periods(spark, sf):
    return periods(spark, sf).select("period", "train_start", "train_end", "test_start", "test_end")


@query("period_counts", with_entries(PERIODS_SQL + "\nSELECT period, n_train, n_test FROM periods"))
def q_period_counts(spark, sf):
    return periods(spark, sf).select("period", "n_train", "n_test")


@query("calibration_holdout", with_entries(PERIODS_SQL + f"""
, tr AS (
  SELECT p.period, e.*, row_number() OVER (PARTITION BY p.period ORDER BY {", ".join("e." + c for c in ORD.split(", "))}) - 1 AS k,
         count(*) OVER (PARTITION BY p.period) AS n
  FROM periods p JOIN entries e ON e.race_date >= p.train_start AND e.race_date <= p.train_end
), roles AS (SELECT *, CASE WHEN k < floor(n * 0.8) THEN 'fit' ELSE 'calibration' END AS role FROM tr)
SELECT period, role, CAST(count(*) AS BIGINT) AS rows, min(race_date) AS first_date, max(race_date) AS last_date,
       CAST(sum(race_id * 10 + ln) AS BIGINT) AS checksum
FROM roles GROUP BY period, role"""))
def q_calibration_holdout(spark, sf):
    """H4 + H5: sizes, dates and a checksum of each period's fit and calibration rows."""
    e = entries(spark, sf).withColumn("checksum", (F.col("race_id") * 10 + F.col("ln")).cast("long"))
    return S.holdout_stats(e, periods(spark, sf), HISTORY_ORDER, 0.2, ["checksum"])


PTEST_SQL = """
, ptest0 AS (
  SELECT p.period, e.* EXCLUDE (predicted_rank) FROM periods p JOIN preds e
  ON e.race_date >= p.test_start AND e.race_date <= p.test_end
), ptest AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY period, race_id ORDER BY predicted_prob DESC, horse_id, ln,
         jockey_id, price, ship) AS BIGINT) AS predicted_rank FROM ptest0
)"""


def period_predictions(spark, sf):
    p = predictions(spark, sf).drop("predicted_rank")
    t = S.assign_periods(p, periods(spark, sf), side="test")
    return predicted_rank(t, tie_break=TIE, by=["period"])


@query("backtest_metrics", with_entries(PREDS_SQL + PERIODS_SQL + PTEST_SQL + metrics_all_sql("ptest", "period")))
def q_backtest_metrics(spark, sf):
    """H8: every metric per period, one job over all periods."""
    m = M.compute_all(period_predictions(spark, sf), by=["period"], has_betting=True)
    return m.select("period", "metric", r6("value").alias("value"))


@query("backtest_overall", with_entries(PREDS_SQL + PERIODS_SQL + PTEST_SQL
                                        + ", ptest_all AS (SELECT 0 AS overall, * FROM ptest)"
                                        + metrics_all_sql("ptest_all", "overall").replace(
                                            "SELECT overall, '", "SELECT '")))
def q_backtest_overall(spark, sf):
    """H8: metrics on the union of all period predictions (rows of overlapping
    windows count once per period, as in the reference)."""
    m = M.compute_all(period_predictions(spark, sf), has_betting=True)
    return m.select("metric", r6("value").alias("value"))


SUMMARY_METRICS = ["win_accuracy", "place_accuracy", "top3_accuracy", "ndcg", "ndcg_at_3", "auc_roc"]


def backtest_summary(spark, sf):
    """H9: one row per period with bounds, sizes and the metrics as columns."""
    p = periods(spark, sf)
    m = M.compute_all(period_predictions(spark, sf), by=["period"], has_betting=True)
    wide = m.groupBy("period").pivot("metric", SUMMARY_METRICS).agg(F.first("value"))
    return p.join(wide, "period", "left")


@query("backtest_summary", with_entries(PREDS_SQL + PERIODS_SQL + PTEST_SQL + metrics_all_sql("ptest", "period")
                                        .replace("\nSELECT period, 'win_accuracy'", "\n, longm AS (SELECT period, 'win_accuracy'", 1)
                                        + ")\nSELECT p.period, p.train_start, p.train_end, p.test_start, p.test_end, p.n_train, p.n_test, "
                                        + ", ".join(f"(SELECT value FROM longm l WHERE l.period = p.period AND l.metric = '{m}') AS {m}"
                                                    for m in SUMMARY_METRICS)
                                        + " FROM periods p"))
def q_backtest_summary(spark, sf):
    s = backtest_summary(spark, sf)
    return s.select("period", "train_start", "train_end", "test_start", "test_end", "n_train", "n_test",
                    *[r6(c).alias(c) for c in SUMMARY_METRICS])


@query("temporal_integrity", with_entries(PERIODS_SQL + """
, tr AS (SELECT p.period, max(e.race_date) AS train_max FROM periods p JOIN entries e
         ON e.race_date >= p.train_start AND e.race_date <= p.train_end GROUP BY p.period),
te AS (SELECT p.period, min(e.race_date) AS test_min FROM periods p JOIN entries e
         ON e.race_date >= p.test_start AND e.race_date <= p.test_end GROUP BY p.period)
SELECT period, train_max, test_min, train_max < test_min AS ok FROM tr FULL JOIN te USING (period)"""))
def q_temporal_integrity(spark, sf):
    """Latest training and earliest test day of each period."""
    return S.period_integrity(entries(spark, sf), periods(spark, sf))


@query("time_fold_table", with_entries(f"""
, n AS (SELECT count(*) AS n FROM entries),
f AS (SELECT CAST(i AS BIGINT) AS fold, n, n // {K_FOLDS + 1} AS size FROM n, range(0, {K_FOLDS}) t(i))
SELECT fold, CAST(n - ({K_FOLDS} - fold) * size AS BIGINT) AS test_start,
       CAST(n - ({K_FOLDS} - fold) * size + size - 1 AS BIGINT) AS test_end,
       CAST(n - ({K_FOLDS} - fold) * size AS BIGINT) AS n_train, CAST(size AS BIGINT) AS n_test FROM f"""))
def q_time_fold_table(spark, sf):
    """H2 summary: one row per fold with its test block and sizes (in positions)."""
    return S.fold_table(entries(spark, sf), K_FOLDS)
