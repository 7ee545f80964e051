"""Monitoring, drift and report tables.

The metric history is a table (seq, ts, label, metric, value), appended to
per snapshot; alerts, trends, drift and reports are queries over it. Every
reduction is an aggregate over the metric history or over one pass of the
feature frame; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paddock.operators.sequence import with_position
from paddock.session import values_frame

# Default alert thresholds.
DEFAULT_THRESHOLDS = {"win_accuracy": 0.05, "place_accuracy": 0.20, "auc_roc": 0.55, "recovery_rate": 0.70}
# Report sections and their metrics, in display order.
SECTIONS = [
    ("Accuracy", ["win_accuracy", "place_accuracy", "top3_accuracy"]),
    ("ML Performance", ["auc_roc", "precision", "recall", "f1", "log_loss", "ndcg", "ndcg_at_3"]),
    ("Profitability", ["recovery_rate", "roi", "expected_value"]),
]
ALERT_SCHEMA = "alert_type string, metric_name string, current_value double, threshold double, message string"


def f4(c: Column) -> Column:
    """Number with 4 decimals (rounded first, so no tie depends on the engine)."""
    return F.format_string("%.4f", F.round(c, 4))


def pct1(c: Column) -> Column:
    """Share as a percentage with one decimal, e.g. 0.1234 -> '12.3%'."""
    return F.concat(F.format_string("%.1f", F.round(c * 100, 1)), F.lit("%"))


def _small(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    return values_frame(spark, list(rows), schema)


# -- L1 ----------------------------------------------------------------------
def record(history: DataFrame | None, snapshot: DataFrame, seq: int | Column, label: str | Column,
           ts: Column | None = None) -> DataFrame:
    """Append one snapshot (metric, value rows) to the history."""
    row = snapshot.select(
        (seq if isinstance(seq, Column) else F.lit(seq)).cast("long").alias("seq"),
        (ts if ts is not None else F.current_timestamp()).alias("ts"),
        (label if isinstance(label, Column) else F.lit(label)).alias("label"),
        "metric", F.col("value").cast("double"))
    return row if history is None else history.unionByName(row)


# -- L2 ----------------------------------------------------------------------
def threshold_alerts(history: DataFrame, thresholds: Mapping[str, float] | None = None) -> DataFrame:
    """Metrics of the latest snapshot below their threshold."""
    th = thresholds or DEFAULT_THRESHOLDS
    spark = history.sparkSession
    t = _small(spark, list(th.items()), "metric string, threshold double")
    latest = history.agg(F.max("seq").alias("seq"))
    cur = history.join(F.broadcast(latest), "seq").join(F.broadcast(t), "metric")
    bad = cur.filter(F.col("value").isNotNull() & (F.col("value") < F.col("threshold")))
    return bad.select(F.lit("degradation").alias("alert_type"), F.col("metric").alias("metric_name"),
                      F.col("value").alias("current_value"), "threshold",
                      F.concat(F.col("metric"), F.lit(" = "), f4(F.col("value")), F.lit(" is below threshold "),
                               f4(F.col("threshold"))).alias("message"))


# -- L3 ----------------------------------------------------------------------
def trend(history: DataFrame, metrics: Sequence[str] | None = None, window: int = 5) -> DataFrame:
    """Mean of the last ``window`` snapshots vs the ``window`` before, per metric.

    Only computed with at least 2*window snapshots. ``alert`` when the
    previous mean is positive and the relative change is below -10%.
    """
    metrics = list(metrics or DEFAULT_THRESHOLDS)
    snaps = history.select("seq").distinct()
    age = snaps.withColumn("_age", F.row_number().over(Window.orderBy(F.col("seq").desc())) - 1)  # snapshots only
    h = history.filter(F.col("metric").isin(metrics)).join(F.broadcast(age), "seq").filter(
        F.col("_age") < 2 * window)
    n = snaps.agg(F.count(F.lit(1)).alias("_n"))
    g = h.groupBy("metric").agg(
        F.avg(F.when(F.col("_age") < window, F.col("value"))).alias("recent_avg"),
        F.avg(F.when(F.col("_age") >= window, F.col("value"))).alias("prev_avg"))
    g = g.withColumn("_k", F.lit(0)).join(F.broadcast(n.withColumn("_k", F.lit(0))), "_k") \
         .filter(F.col("_n") >= 2 * window).drop("_k", "_n")
    change = F.when(F.col("prev_avg") > 0, (F.col("recent_avg") - F.col("prev_avg")) / F.col("prev_avg"))
    return g.withColumn("change", change).withColumn(
        "alert", F.coalesce(F.col("change") < -0.1, F.lit(False)))


def trend_alerts(history: DataFrame, metrics: Sequence[str] | None = None, window: int = 5) -> DataFrame:
    t = trend(history, metrics, window).filter("alert")
    return t.select(F.lit("degradation").alias("alert_type"), F.col("metric").alias("metric_name"),
                    F.col("recent_avg").alias("current_value"), F.col("prev_avg").alias("threshold"),
                    F.concat(F.col("metric"), F.lit(" dropped "), pct1(F.abs(F.col("change"))),
                             F.lit(f" over recent {window} periods (from "), f4(F.col("prev_avg")),
                             F.lit(" to "), f4(F.col("recent_avg")), F.lit(")")).alias("message"))


# -- L4, L5 ------------------------------------------------------------------
NUMERIC = ("double", "float", "bigint", "int")


def drift(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None,
          threshold: float = 0.1) -> DataFrame:
    """Mean and sample-std drift per numeric column: one aggregate per side.

    Alert when |cur - ref| / |ref| > threshold; skipped when |ref| <= 1e-10 or
    either mean is null.
    """
    if columns is None:
        columns = [c for c, t in reference.dtypes if t in NUMERIC]
    columns = [c for c in columns if c in reference.columns and c in current.columns]

    def stats(df: DataFrame, side: str) -> DataFrame:
        a = df.agg(*[x for c in columns for x in (F.avg(F.col(c).cast("double")).alias(f"m{c}"),
                                                  F.stddev_samp(F.col(c).cast("double")).alias(f"s{c}"))])
        stack = F.expr("stack({}, {})".format(len(columns), ", ".join(f"'{c}', m{c}, s{c}" for c in columns)))
        return a.select(stack.alias("column", f"{side}_mean", f"{side}_std"))

    s = stats(reference, "ref").join(stats(current, "cur"), "column")
    s = s.filter(F.col("ref_mean").isNotNull() & F.col("cur_mean").isNotNull())
    mean_ch = F.abs(F.col("cur_mean") - F.col("ref_mean")) / F.abs(F.col("ref_mean"))
    std_ch = F.abs(F.col("cur_std") - F.col("ref_std")) / F.abs(F.col("ref_std"))
    m = s.filter(F.abs(F.col("ref_mean")) > 1e-10).withColumn("_ch", mean_ch).filter(F.col("_ch") > threshold)
    m = m.select(F.lit("drift").alias("alert_type"), F.concat(F.col("column"), F.lit("_mean")).alias("metric_name"),
                 F.col("cur_mean").alias("current_value"), F.col("ref_mean").alias("threshold"),
                 F.concat(F.lit("Column '"), F.col("column"), F.lit("' mean shifted by "), pct1(F.col("_ch")),
                          F.lit(" (ref="), f4(F.col("ref_mean")), F.lit(", cur="), f4(F.col("cur_mean")),
                          F.lit(")")).alias("message"))
    sd = s.filter(F.col("ref_std").isNotNull() & F.col("cur_std").isNotNull()
                  & (F.abs(F.col("ref_std")) > 1e-10)).withColumn("_ch", std_ch).filter(F.col("_ch") > threshold)
    sd = sd.select(F.lit("drift").alias("alert_type"), F.concat(F.col("column"), F.lit("_std")).alias("metric_name"),
                   F.col("cur_std").alias("current_value"), F.col("ref_std").alias("threshold"),
                   F.concat(F.lit("Column '"), F.col("column"), F.lit("' std shifted by "), pct1(F.col("_ch")),
                            F.lit(" (ref="), f4(F.col("ref_std")), F.lit(", cur="), f4(F.col("cur_std")),
                            F.lit(")")).alias("message"))
    return m.unionByName(sd)


# -- L6 ----------------------------------------------------------------------
def health(alerts: DataFrame) -> DataFrame:
    """(n_alerts, is_healthy)."""
    return alerts.agg(F.count(F.lit(1)).cast("long").alias("n_alerts")).withColumn(
        "is_healthy", F.col("n_alerts") == 0)


# -- L7 ----------------------------------------------------------------------
# The sentences of alerts and verdicts in this module are part of the reported rows.
def leakage_report(period_auc: DataFrame, train_auc: DataFrame | None = None,
                   gap_limit: float = 0.1) -> tuple[DataFrame, DataFrame]:
    """Per-period AUC statistics, anomalous periods and the train gap.

    ``period_auc``: (period, auc_roc). ``train_auc``: one row (train_auc).
    Returns (summary one row, anomalies rows).
    """
    s = period_auc.agg(
        F.count(F.lit(1)).cast("long").alias("n_periods"), F.avg("auc_roc").alias("mean_auc"),
        F.coalesce(F.stddev_samp("auc_roc"), F.lit(0.0)).alias("std_auc"),
        F.min("auc_roc").alias("min_auc"), F.max("auc_roc").alias("max_auc"))
    s = s.withColumn("cv", F.when(F.col("mean_auc") > 0, F.col("std_auc") / F.col("mean_auc")).otherwise(0.0))
    s = s.withColumn("spike_threshold", F.col("mean_auc") + 2 * F.col("std_auc")).withColumn("_k", F.lit(0))
    an = period_auc.withColumn("_k", F.lit(0)).join(F.broadcast(s.select("_k", "spike_threshold", "std_auc")), "_k") \
        .filter((F.col("auc_roc") > F.col("spike_threshold")) & (F.col("std_auc") > 0))
    an = an.select("period", "auc_roc", "spike_threshold", F.concat(
        F.lit("WARNING: Period "), F.col("period").cast("string"), F.lit(" AUC "), f4(F.col("auc_roc")),
        F.lit(" > "), f4(F.col("spike_threshold")), F.lit(" (mean + 2*std) - potential leakage")).alias("message"))
    n_an = an.agg(F.count(F.lit(1)).cast("long").alias("n_anomalies")).withColumn("_k", F.lit(0))
    s = s.join(F.broadcast(n_an), "_k")
    if train_auc is not None:
        s = s.join(F.broadcast(train_auc.withColumn("_k", F.lit(0))), "_k")
        s = s.withColumn("gap", F.col("train_auc") - F.col("mean_auc"))
        gap_warn = F.col("gap") >= gap_limit
    else:
        s = s.withColumn("train_auc", F.lit(None).cast("double")).withColumn("gap", F.lit(None).cast("double"))
        gap_warn = F.lit(False)
    warn = (F.col("n_anomalies") > 0) | gap_warn
    s = s.withColumn("verdict", F.when(warn, "Potential issues detected")
                     .otherwise("No significant temporal data leakage detected."))
    return s.drop("_k"), an


# -- L8 ----------------------------------------------------------------------
def metrics_sections(metrics: DataFrame) -> DataFrame:
    """(section, position, display_name, metric, value) for metrics present,
    in the fixed section order."""
    spark = metrics.sparkSession
    rows = [(sec, si * 100 + mi, m) for si, (sec, ms) in enumerate(SECTIONS) for mi, m in enumerate(ms)]
    sm = _small(spark, rows, "section string, position int, metric string")
    out = metrics.join(F.broadcast(sm), "metric")
    return out.select("section", F.col("position").cast("long"),
                      F.initcap(F.regexp_replace("metric", "_", " ")).alias("display_name"), "metric", "value")


# -- L9 ----------------------------------------------------------------------
def period_table(periods: DataFrame, metrics_long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Period, test range, n_test and the first metrics as columns (missing -> 0)."""
    wide = metrics_long.groupBy("period").pivot("metric", list(keys)).agg(F.first("value"))
    out = periods.join(wide, "period", "left")
    return out.select("period", F.concat(F.col("test_start").cast("string"), F.lit(" ~ "),
                                         F.col("test_end").cast("string")).alias("test_range"),
                      "n_test", *[F.coalesce(F.col(k), F.lit(0.0)).alias(k) for k in keys])


# -- L10, L11 ----------------------------------------------------------------
def run_log(events: DataFrame, run: str, key: str, value: str, ts: str,
            order: Sequence[str]) -> DataFrame:
    """Long-form run log (run_id, start_time, key, value, step): step is the
    position of the logged value inside its run."""
    x = with_position(events, [run], list(order), name="step")
    start = events.groupBy(F.col(run).alias("_run")).agg(F.min(ts).alias("start_time"))
    return x.join(start, F.col(run).eqNullSafe(F.col("_run"))).select(F.col(run).alias("run_id"), "start_time", F.col(key).alias("key"),
                                     F.col(value).cast("double").alias("value"), "step")


def run_comparison(log: DataFrame, keys: Sequence[str], newest: int = 5,
                   sort_metric: str | None = None) -> DataFrame:
    """Newest runs with one column per key (the key's last logged value).

    The newest-N cut is the feature (a top-k report); runs are first reduced
    to one row each, so the sort is over runs, not log rows.
    """
    last = log.groupBy("run_id", "start_time").pivot("key", list(keys)).agg(
        F.max_by("value", "step"))
    top = last.orderBy(F.col("start_time").desc(), F.col("run_id").desc()).limit(newest)
    if sort_metric and sort_metric in top.columns:
        top = top.orderBy(F.col(sort_metric).desc_nulls_last(), F.col("run_id"))
    return top
