"""Splits, folds and walk-forward periods."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from paddock.operators import splits as S

ORDER = ["race_date", "rid"]


def _days(spark, n_days=120, per_day=3):
    base = dt.date(2021, 1, 1)
    rows = [(base + dt.timedelta(days=d), d * 10 + k) for d in range(n_days) for k in range(per_day)]
    return spark.createDataFrame(rows, "race_date date, rid long")


def test_temporal_split_counts_and_order(spark):
    df = _days(spark)
    s = S.temporal_split(df, ORDER, 0.2)
    n = df.count()
    tr = s.filter(F.col("split") == "train")
    assert tr.count() == int(n * 0.8)
    assert tr.agg(F.max("rid")).first()[0] < s.filter(F.col("split") == "validation").agg(F.min("rid")).first()[0]


def test_split_by_date_never_cuts_a_day(spark):
    s = S.temporal_split(_days(spark, 10, 3), ORDER, 0.25, mode="date")
    mixed = s.groupBy("race_date").agg(F.countDistinct("split").alias("k")).filter("k > 1").count()
    assert mixed == 0


def test_time_folds_layout(spark):
    df = _days(spark, 12, 1)     # n = 12, 5 splits -> test size 2, first test block at 2
    f = {r["rid"]: r["test_fold"] for r in S.time_folds(df, ORDER, 5).collect()}
    assert [f[d * 10] for d in range(12)] == [None, None, 0, 0, 1, 1, 2, 2, 3, 3, 4, 4]


def test_periods_and_integrity(spark):
    df = _days(spark, 60, 2)
    p = S.walk_forward_periods(df, train_window=21, test_window=7, step=7).orderBy("period").collect()
    assert p[0]["test_start"] == dt.date(2021, 1, 22) and p[0]["n_train"] == 42 and p[0]["n_test"] == 14
    periods = S.walk_forward_periods(df, 21, 7, 7)
    chk = S.temporal_integrity(S.assign_periods(df, periods, "train"), S.assign_periods(df, periods, "test"))
    assert chk.filter(~F.col("ok")).count() == 0


def test_calibration_holdout_last_fifth(spark):
    df = _days(spark, 10, 1).withColumn("period", F.lit(0))
    r = {x["rid"]: x["role"] for x in S.calibration_holdout(df, ORDER, 0.2).collect()}
    assert [r[d * 10] for d in range(10)] == ["fit"] * 8 + ["calibration"] * 2


def test_null_and_timestamp_dates_are_kept(spark):
    import datetime as dt

    from paddock.operators.splits import calibration_holdout, temporal_split, time_folds
    rows = [(i, None if i % 4 == 0 else dt.datetime(2024, 1, 1 + i % 9, i % 24)) for i in range(100)]
    df = spark.createDataFrame(rows, "race_id long, race_date timestamp")
    out = temporal_split(df, ["race_date", "race_id"], 0.2).collect()
    assert len(out) == 100 and sum(r["split"] == "train" for r in out) == 80
    dated = [r["race_date"] for r in out if r["split"] == "train" and r["race_date"]]
    assert len(dated) == 75 and all(r["race_date"] is None for r in out if r["split"] == "validation")
    folds = time_folds(df, ["race_date", "race_id"], 4).collect()
    assert sorted(r["position"] for r in folds) == list(range(100))
    by_time = sorted((r for r in folds if r["race_date"]), key=lambda r: r["position"])
    assert [r["race_date"] for r in by_time] == sorted(r["race_date"] for r in by_time)
    roles = calibration_holdout(df.selectExpr("*", "race_id % 2 AS period"), ["race_date", "race_id"], 0.2).collect()
    assert len(roles) == 100 and sum(r["role"] == "fit" for r in roles) == 80


@pytest.mark.parametrize("kind", ["date", "timestamp"])
def test_holdout_stats_equal_the_tagged_copies(spark, kind):
    rnd = random.Random(11)
    rows = [(i, dt.date(2024, 1, 1) + dt.timedelta(days=rnd.choice([3, 3, 3, 40, rnd.randint(0, 90)])), rnd.randint(0, 9)) for i in range(400)]
    rows += [(900 + i, None, 5) for i in range(5)] + [(990, dt.date(2024, 1, 4), None)]
    df = spark.createDataFrame(rows, "id long, race_date date, v long")
    if kind == "timestamp":
        df = df.withColumn("race_date", F.col("race_date").cast("timestamp") + F.expr("make_dt_interval(0, 0, pmod(id * 37, 600))"))
    order = ["race_date", "id"]
    p = S.walk_forward_periods(df, 30, 10, 7)
    got = S.holdout_stats(df, p, order, 0.3, ["v"])
    tagged = S.calibration_holdout(S.assign_periods(df, p, "train"), order, 0.3)
    want = tagged.groupBy("period", "role").agg(
        F.count(F.lit(1)).alias("rows"), F.min(F.col("race_date").cast("date")).alias("first_date"),
        F.max(F.col("race_date").cast("date")).alias("last_date"), F.sum("v").alias("v"))
    a, b = sorted(map(tuple, got.collect())), sorted(map(tuple, want.collect()))
    assert a == b and len(a) > 10
    ok = S.period_integrity(df, p)
    assert ok.columns == ["period", "train_max", "test_min", "ok"] and ok.count() == p.count() and ok.filter("not ok").count() == 0
