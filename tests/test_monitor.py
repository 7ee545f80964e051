"""Alerts, drift and leakage tables."""

from pyspark.sql import functions as F

from paddock.operators import monitor as MO


def _history(spark, values):
    rows = [(i, f"s{i}", "win_accuracy", v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "seq long, label string, metric string, value double") \
        .withColumn("ts", F.current_timestamp())


def test_threshold_alert_on_latest_only(spark):
    h = _history(spark, [0.01, 0.2])
    assert MO.threshold_alerts(h).count() == 0
    a = MO.threshold_alerts(_history(spark, [0.2, 0.01])).first()
    assert a["metric_name"] == "win_accuracy" and a["message"] == "win_accuracy = 0.0100 is below threshold 0.0500"


def test_trend_alert_on_half_drop(spark):
    h = _history(spark, [0.2] * 5 + [0.1] * 5)
    a = MO.trend_alerts(h, ["win_accuracy"]).collect()
    assert len(a) == 1 and "dropped 50.0%" in a[0]["message"]
    assert MO.trend_alerts(_history(spark, [0.2] * 9), ["win_accuracy"]).count() == 0   # needs 2 windows


def test_drift_mean_tenfold(spark):
    ref = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (4.0, 5.0), (5.0, 5.0)], "feat_a double, feat_b double")
    cur = ref.withColumn("feat_a", F.col("feat_a") * 10)
    names = {r["metric_name"] for r in MO.drift(ref, cur).collect()}
    assert names == {"feat_a_mean", "feat_a_std"}


def test_leakage_spike_flagged(spark):
    vals = [0.6] * 9 + [0.99]
    pa = spark.createDataFrame(list(enumerate(vals)), "period long, auc_roc double")
    s, an = MO.leakage_report(pa, spark.createDataFrame([(0.65,)], "train_auc double"))
    assert [r["period"] for r in an.collect()] == [9]
    assert s.first()["verdict"] == "Potential issues detected"
    flat = spark.createDataFrame([(i, 0.6) for i in range(5)], "period long, auc_roc double")
    s2, an2 = MO.leakage_report(flat)
    assert an2.count() == 0 and s2.first()["verdict"].startswith("No significant")


def test_sections_order_and_names(spark):
    m = spark.createDataFrame([("roi", 0.1), ("auc_roc", 0.7), ("win_accuracy", 0.2)], "metric string, value double")
    rows = MO.metrics_sections(m).orderBy("position").collect()
    assert [(r["section"], r["display_name"]) for r in rows] == [
        ("Accuracy", "Win Accuracy"), ("ML Performance", "Auc Roc"), ("Profitability", "Roi")]
