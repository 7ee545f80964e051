"""Queries for monitoring, drift and report tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from paddock.operators import metrics as M
from paddock.operators import monitor as MO
from paddock.operators import runlog as RL
from paddock.plans.bindings import entries, with_entries
from paddock.plans.catalog import query, r6
from paddock.plans.q_metrics import PREDS_SQL, auc_sql, metrics_all_sql, predictions
from paddock.plans.q_splits import PERIODS_SQL, PTEST_SQL, period_predictions, periods
from paddock.session import scratch_dir
from paddock.sources.sinks import write_table
from paddock.sources.tables import table

METRICS4 = ["win_accuracy", "place_accuracy", "auc_roc", "recovery_rate"]
SPLIT_TS = dt.datetime(2024, 1, 16)


def snapshots(spark, sf):
    """One metrics snapshot per day of events (seq = day index)."""
    ev = table(spark, sf, "events")
    day = ev.groupBy(F.to_date("ts").alias("d")).agg(
        F.avg(F.when(F.col("event_type") == "purchase", 1.0).otherwise(0.0)).alias("win_accuracy"),
        F.avg(F.when(F.col("event_type") == "click", 1.0).otherwise(0.0)).alias("place_accuracy"),
        F.avg(F.when(F.col("value") > 25, 1.0).otherwise(0.0)).alias("auc_roc"),
        (F.avg("value") / 70.0).alias("recovery_rate"))
    day = day.withColumn("seq", F.row_number().over(Window.orderBy("d")).cast("long"))  # one row per day
    stack = F.expr("stack(4, " + ", ".join(f"'{m}', {m}" for m in METRICS4) + ")")
    return day.select("seq", F.col("d").cast("timestamp_ntz").alias("ts"),
                      F.date_format("d", "yyyy-MM-dd").alias("label"), stack.alias("metric", "value"))


HIST_SQL = """
, snap AS (
  SELECT CAST(ts AS DATE) AS d,
         avg(CASE WHEN event_type = 'purchase' THEN 1.0e0 ELSE 0.0e0 END) AS win_accuracy,
         avg(CASE WHEN event_type = 'click' THEN 1.0e0 ELSE 0.0e0 END) AS place_accuracy,
         avg(CASE WHEN value > 25 THEN 1.0e0 ELSE 0.0e0 END) AS auc_roc,
         avg(value) / 70.0 AS recovery_rate
  FROM events GROUP BY 1
), snap2 AS (SELECT *, CAST(row_number() OVER (ORDER BY d) AS BIGINT) AS seq FROM snap),
hist AS (
""" + "\n  UNION ALL ".join(
    f"SELECT seq, CAST(d AS TIMESTAMP) AS ts, strftime(d, '%Y-%m-%d') AS label, '{m}' AS metric, {m} AS value FROM snap2"
    for m in METRICS4) + "\n)"


def W(sql):
    return "WITH _x AS (SELECT 1)" + sql


@query("metric_history", W(HIST_SQL + "\nSELECT seq, ts, label, metric, round(value, 6) AS value FROM hist"))
def q_metric_history(spark, sf):
    """L1: snapshots recorded one part after the other into a stored history."""
    path = scratch_dir(spark, "metric-history")
    days = snapshots(spark, sf)
    for part in (days.filter("seq % 2 = 1"), days.filter("seq % 2 = 0")):
        write_table(MO.record(None, part.select("seq", "ts", "label", "metric", "value"), F.col("seq"), F.col("label"), F.col("ts")), path)
    return spark.read.parquet(path).select("seq", "ts", "label", "metric", r6("value").alias("value"))


TH_SQL = "(VALUES " + ", ".join(f"('{k}', CAST({v} AS DOUBLE))" for k, v in MO.DEFAULT_THRESHOLDS.items()) + ") th(metric, threshold)"


def f4(x):
    return f"printf('%.4f', round({x}, 4))"


def pct1(x):
    return f"printf('%.1f', round({x} * 100, 1)) || '%'"


THRESH_ALERTS_SQL = HIST_SQL + f"""
, talerts AS (
  SELECT 'degradation' AS alert_type, h.metric AS metric_name, h.value AS current_value, th.threshold,
         h.metric || ' = ' || {f4('h.value')} || ' is below threshold ' || {f4('th.threshold')} AS message
  FROM hist h JOIN {TH_SQL} ON h.metric = th.metric
  WHERE h.seq = (SELECT max(seq) FROM hist) AND h.value < th.threshold
)"""


def _alert_cols(df):
    return df.select("alert_type", "metric_name", r6("current_value").alias("current_value"),
                     r6("threshold").alias("threshold"), "message")


ALERT_SELECT = "SELECT alert_type, metric_name, round(current_value, 6) AS current_value, round(threshold, 6) AS threshold, message FROM "


@query("threshold_alerts", W(THRESH_ALERTS_SQL + "\n" + ALERT_SELECT + "talerts"))
def q_threshold_alerts(spark, sf):
    return _alert_cols(MO.threshold_alerts(snapshots(spark, sf)))


TREND_SQL = HIST_SQL + f"""
, aged AS (SELECT h.*, s.age FROM hist h JOIN (SELECT seq, row_number() OVER (ORDER BY seq DESC) - 1 AS age
           FROM (SELECT DISTINCT seq FROM hist)) s USING (seq) WHERE s.age < 10),
tr AS (
  SELECT metric, avg(CASE WHEN age < 5 THEN value END) AS recent_avg, avg(CASE WHEN age >= 5 THEN value END) AS prev_avg
  FROM aged WHERE metric IN ({", ".join(f"'{m}'" for m in MO.DEFAULT_THRESHOLDS)})
    AND (SELECT count(DISTINCT seq) FROM hist) >= 10 GROUP BY metric
), tr2 AS (SELECT *, CASE WHEN prev_avg > 0 THEN (recent_avg - prev_avg) / prev_avg END AS change FROM tr),
tralerts AS (
  SELECT 'degradation' AS alert_type, metric AS metric_name, recent_avg AS current_value, prev_avg AS threshold,
         metric || ' dropped ' || {pct1('abs(change)')} || ' over recent 5 periods (from ' || {f4('prev_avg')}
         || ' to ' || {f4('recent_avg')} || ')' AS message
  FROM tr2 WHERE change < -0.1
)"""


@query("trend_alerts", W(TREND_SQL + """
SELECT metric, round(recent_avg, 6) AS recent_avg, round(prev_avg, 6) AS prev_avg, round(change, 6) AS change,
       COALESCE(change < -0.1, false) AS alert FROM tr2"""))
def q_trend_alerts(spark, sf):
    t = MO.trend(snapshots(spark, sf))
    return t.select("metric", r6("recent_avg").alias("recent_avg"), r6("prev_avg").alias("prev_avg"),
                    r6("change").alias("change"), "alert")


DRIFT_COLS = ["event_id", "user_id", "value"]


#: An early cut for the spread: ids rise with time, so the two sides differ.
STD_TS = dt.datetime(2024, 1, 6)


def _drift(spark, sf, at=SPLIT_TS):
    ev = table(spark, sf, "events")
    cut = F.lit(str(at)).cast("timestamp_ntz")            # event times carry no time zone
    return MO.drift(ev.filter(F.col("ts") < cut), ev.filter(F.col("ts") >= cut), DRIFT_COLS, 0.1)


def _drift_sql(at=SPLIT_TS):
    parts = []
    for c in DRIFT_COLS:
        for kind, fn in (("mean", "avg"), ("std", "stddev_samp")):
            ref = f"(SELECT {fn}(CAST({c} AS DOUBLE)) FROM events WHERE ts < TIMESTAMP '{at}')"
            cur = f"(SELECT {fn}(CAST({c} AS DOUBLE)) FROM events WHERE ts >= TIMESTAMP '{at}')"
            ch = f"abs({cur} - {ref}) / abs({ref})"
            parts.append(
                f"SELECT 'drift' AS alert_type, '{c}_{kind}' AS metric_name, {cur} AS current_value, {ref} AS threshold, "
                f"'Column ''{c}'' {kind} shifted by ' || {pct1(ch)} || ' (ref=' || {f4(ref)} || ', cur=' || {f4(cur)} || ')' AS message "
                f"WHERE {ref} IS NOT NULL AND {cur} IS NOT NULL AND abs({ref}) > 1e-10 AND {ch} > 0.1")
    return ", dalerts AS (" + "\nUNION ALL ".join(parts) + ")"


DRIFT_SQL = _drift_sql()


@query("drift_mean", W(DRIFT_SQL + "\n" + ALERT_SELECT + "dalerts WHERE metric_name LIKE '%\\_mean' ESCAPE '\\'"))
def q_drift_mean(spark, sf):
    return _alert_cols(_drift(spark, sf).filter(F.col("metric_name").endswith("_mean")))


@query("drift_std", W(_drift_sql(STD_TS) + "\n" + ALERT_SELECT + "dalerts WHERE metric_name LIKE '%\\_std' ESCAPE '\\'"))
def q_drift_std(spark, sf):
    return _alert_cols(_drift(spark, sf, STD_TS).filter(F.col("metric_name").endswith("_std")))


@query("health", W(THRESH_ALERTS_SQL + TREND_SQL.replace(HIST_SQL, "") + DRIFT_SQL + """
, al AS (SELECT * FROM talerts UNION ALL SELECT * FROM tralerts UNION ALL SELECT * FROM dalerts)
SELECT CAST(count(*) AS BIGINT) AS n_alerts, count(*) = 0 AS is_healthy FROM al"""))
def q_health(spark, sf):
    h = snapshots(spark, sf)
    alerts = MO.threshold_alerts(h).unionByName(MO.trend_alerts(h)).unionByName(_drift(spark, sf))
    return MO.health(alerts)


@query("leakage_report", with_entries(PREDS_SQL + PERIODS_SQL + PTEST_SQL + auc_sql("ptest", "period")
                                    + auc_sql("preds", name="auc0") + """
, tra AS (SELECT auc_roc AS train_auc FROM auc0),
s AS (SELECT count(*) AS n_periods, avg(auc_roc) AS mean_auc, COALESCE(stddev_samp(auc_roc), 0.0) AS std_auc,
             min(auc_roc) AS min_auc, max(auc_roc) AS max_auc FROM auc),
s2 AS (SELECT *, CASE WHEN mean_auc > 0 THEN std_auc / mean_auc ELSE 0.0 END AS cv,
              mean_auc + 2 * std_auc AS spike_threshold FROM s),
an AS (SELECT count(*) AS n_anomalies FROM auc, s2 WHERE auc.auc_roc > s2.spike_threshold AND s2.std_auc > 0)
SELECT CAST(n_periods AS BIGINT) AS n_periods, round(mean_auc, 6) AS mean_auc, round(std_auc, 6) AS std_auc,
       round(min_auc, 6) AS min_auc, round(max_auc, 6) AS max_auc, round(cv, 6) AS cv,
       round(spike_threshold, 6) AS spike_threshold, CAST(n_anomalies AS BIGINT) AS n_anomalies,
       round(train_auc, 6) AS train_auc, round(train_auc - mean_auc, 6) AS gap,
       CASE WHEN n_anomalies > 0 OR train_auc - mean_auc >= 0.1 THEN 'Potential issues detected'
            ELSE 'No significant temporal data leakage detected.' END AS verdict
FROM s2, an, tra"""))
def q_leakage_report(spark, sf):
    pa = M.auc_roc(period_predictions(spark, sf), by=["period"])
    ta = M.auc_roc(predictions(spark, sf)).withColumnRenamed("auc_roc", "train_auc")
    s, _ = MO.leakage_report(pa, ta)
    return s.select("n_periods", *[r6(c).alias(c) for c in ("mean_auc", "std_auc", "min_auc", "max_auc", "cv",
                                                          "spike_threshold")],
                    "n_anomalies", r6("train_auc").alias("train_auc"), r6("gap").alias("gap"), "verdict")


@query("leakage_anomalies", with_entries(PREDS_SQL + PERIODS_SQL + PTEST_SQL + auc_sql("ptest", "period") + """
, s AS (SELECT avg(auc_roc) + 2 * COALESCE(stddev_samp(auc_roc), 0.0) AS spike, COALESCE(stddev_samp(auc_roc), 0.0) AS sd FROM auc)
SELECT period, round(auc_roc, 6) AS auc_roc, round(spike, 6) AS spike_threshold FROM auc, s WHERE auc_roc > spike AND sd > 0"""))
def q_leakage_anomalies(spark, sf):
    """The periods whose AUC lies above mean + 2 std."""
    _, a = MO.leakage_report(M.auc_roc(period_predictions(spark, sf), by=["period"]))
    return a.select("period", r6("auc_roc").alias("auc_roc"), r6("spike_threshold").alias("spike_threshold"))


def _sections_sql():
    rows = ", ".join(f"('{sec}', {si * 100 + mi}, '{m}', '{m.replace('_', ' ').title()}')"
                     for si, (sec, ms) in enumerate(MO.SECTIONS) for mi, m in enumerate(ms))
    return with_entries(PREDS_SQL + ", pall AS (SELECT 0 AS g, * FROM preds)" + metrics_all_sql("pall", "g")
                        .replace("\nSELECT g, 'win_accuracy'", "\n, longm AS (SELECT g, 'win_accuracy'", 1) + f""")
SELECT s.section, CAST(s.position AS BIGINT) AS position, s.display_name, l.metric, l.value
FROM longm l JOIN (VALUES {rows}) s(section, position, metric, display_name) USING (metric)""")


@query("metrics_sections", _sections_sql())
def q_metrics_sections(spark, sf):
    m = M.compute_all(predictions(spark, sf), has_betting=True)
    return MO.metrics_sections(m.select("metric", r6("value").alias("value")))


PERIOD_KEYS = ["win_accuracy", "place_accuracy", "top3_accuracy", "ndcg", "ndcg_at_3", "auc_roc"]


@query("period_table", with_entries(PREDS_SQL + PERIODS_SQL + PTEST_SQL + metrics_all_sql("ptest", "period")
                                    .replace("\nSELECT period, 'win_accuracy'", "\n, longm AS (SELECT period, 'win_accuracy'", 1)
                                    + ")\nSELECT p.period, CAST(p.test_start AS VARCHAR) || ' ~ ' || CAST(p.test_end AS VARCHAR) AS test_range, p.n_test, "
                                    + ", ".join(f"COALESCE((SELECT value FROM longm l WHERE l.period = p.period AND l.metric = '{m}'), 0.0) AS {m}"
                                                for m in PERIOD_KEYS) + " FROM periods p"))
def q_period_table(spark, sf):
    m = M.compute_all(period_predictions(spark, sf), by=["period"], has_betting=True)
    t = MO.period_table(periods(spark, sf), m.select("period", "metric", r6("value").alias("value")), PERIOD_KEYS)
    return t


RUN_ORDER = ["ts", "event_id"]
RUN_KEYS = ["click", "error", "purchase", "signup", "view"]


def _log(spark, sf):
    return MO.run_log(table(spark, sf, "events"), "user_id", "event_type", "value", "ts", RUN_ORDER)


RUNLOG_SQL = """
, rl AS (
  SELECT user_id AS run_id, min(ts) OVER (PARTITION BY user_id) AS start_time, event_type AS key,
         value, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS step
  FROM events
)"""


@query("run_log", W(RUNLOG_SQL + "\nSELECT run_id, start_time, key, round(value, 6) AS value, step FROM rl"))
def q_run_log(spark, sf):
    return _log(spark, sf).select("run_id", "start_time", "key", r6("value").alias("value"), "step")


@query("run_comparison", W(RUNLOG_SQL + """
, last AS (
  SELECT run_id, start_time, """ + ", ".join(
    f"arg_max(CASE WHEN key = '{k}' THEN value END, CASE WHEN key = '{k}' THEN step END) AS {k}" for k in RUN_KEYS) + """
  FROM rl GROUP BY run_id, start_time
)
SELECT run_id, start_time, """ + ", ".join(f"round({k}, 6) AS {k}" for k in RUN_KEYS) + """
FROM (SELECT * FROM last ORDER BY start_time DESC, run_id DESC LIMIT 10)"""))
def q_run_comparison(spark, sf):
    c = MO.run_comparison(_log(spark, sf), RUN_KEYS, newest=10, sort_metric="purchase")
    return c.select("run_id", "start_time", *[r6(k).alias(k) for k in RUN_KEYS])


PARAMS = ("opening", "props")
PARAM_SQL = """
, pr AS (
  SELECT user_id, min(ts) AS start_time, arg_min(event_type, (ts, event_id)) AS opening, arg_min(props, (ts, event_id)) AS props
  FROM events WHERE user_id IS NOT NULL GROUP BY user_id
)"""


def _records(spark, sf):
    """Metrics and parameters of all runs, written as two batches (one of them
    twice, as a retried job would) and read back."""
    events = table(spark, sf, "events").filter("user_id is not null")
    first = F.struct("ts", "event_id")
    runs = events.groupBy(F.col("user_id").alias("run_id")).agg(
        F.min("ts").alias("start_time"), F.min_by("event_type", first).alias("opening"), F.min_by("props", first).alias("props"))
    path = scratch_dir(spark, "run-records")
    RL.append_records(RL.param_records(runs, PARAMS), path, "params")
    RL.append_records(RL.metric_records(_log(spark, sf).filter("run_id is not null")), path, "metrics")
    RL.append_records(RL.param_records(runs, PARAMS), path, "params")
    return RL.read_records(spark, path)


@query("run_records", W(RUNLOG_SQL + PARAM_SQL + """
SELECT CAST(run_id AS VARCHAR) AS run_id, start_time, 'metric' AS kind, key, round(value, 6) AS number, NULL::VARCHAR AS text, step, 'metrics' AS batch
FROM rl WHERE run_id IS NOT NULL
UNION ALL SELECT CAST(user_id AS VARCHAR), start_time, 'param', 'opening', NULL, opening, 0, 'params' FROM pr WHERE opening IS NOT NULL
UNION ALL SELECT CAST(user_id AS VARCHAR), start_time, 'param', 'props', NULL, props, 0, 'params' FROM pr WHERE props IS NOT NULL"""))
def q_run_records(spark, sf):
    """The typed run log: parameters as text, metrics as numbers with steps."""
    return _records(spark, sf).withColumn("number", r6("number"))


@query("run_comparison_csv", W(RUNLOG_SQL + PARAM_SQL + """
, last AS (
  SELECT run_id, """ + ", ".join(
    f"arg_max(value, step) FILTER (key = '{k}' AND value IS NOT NULL) AS {k}" for k in RUN_KEYS) + """
  FROM rl WHERE run_id IS NOT NULL GROUP BY run_id
)
SELECT CAST(run_id AS VARCHAR) AS run_id, start_time, opening AS param_opening, props AS param_props, """ + ", ".join(f"round({k}, 6) AS {k}" for k in RUN_KEYS) + """
FROM last JOIN pr ON user_id = run_id ORDER BY start_time DESC, CAST(run_id AS VARCHAR) DESC LIMIT 25"""))
def q_run_comparison_csv(spark, sf):
    """The 25 newest runs with parameter and metric columns, exported as CSV and read back."""
    c = RL.compare_runs(_records(spark, sf), RUN_KEYS, PARAMS, newest=25, sort_metric="purchase")
    path = scratch_dir(spark, "run-comparison")
    RL.export_csv(c, path)
    back = RL.read_csv(spark, path, c._jdf.schema().toDDL())
    return back.select("run_id", "start_time", *[f"param_{p}" for p in PARAMS], *[r6(k).alias(k) for k in RUN_KEYS])
