"""The sequence operators equal plain windows, also for a key with 40 % of the rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from paddock.operators import sequence
from paddock.operators.sequence import desc, rolling, running_sum, with_position


@pytest.fixture(params=[1 << 20, 16, 2, 1])
def cut_every(request, monkeypatch):
    monkeypatch.setattr(sequence, "CUT_EVERY", request.param)
    return request.param


def _data(spark, n=1200, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = 0 if rnd.random() < 0.4 else (None if rnd.random() < 0.03 else rnd.randint(1, 30))
        v = None if rnd.random() < 0.1 else float(rnd.choice([0, -3, 2, 5, 5, 900, 1e-9, -1e30, "nan"]))
        rows.append((k, i, v, rnd.randint(0, 40) if rnd.random() < 0.9 else None))
    return spark.createDataFrame(rows, "k long, t long, v double, d long")


def _same(a, b):
    b = b.select(a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rolling_equals_window(spark, cut_every):
    df = _data(spark)
    got = rolling(df, ["k"], ["t"], 5, means={"m": F.col("d")}, lags={"pd": F.col("d")}, count_name="c")
    w = Window.partitionBy("k").orderBy("t")
    _same(got, df.withColumns({"m": F.avg("d").over(w.rowsBetween(-5, -1)), "pd": F.lag("d").over(w),
                               "c": (F.row_number().over(w) - 1).cast("long")}))


def test_position_total_and_ties(spark, cut_every):
    df = _data(spark)
    w = Window.partitionBy("k")
    got = with_position(df, ["k"], [desc("v"), "t"], total="n")
    _same(got, df.withColumns({"pos": (F.row_number().over(w.orderBy(F.col("v").desc(), "t")) - 1).cast("long"),
                               "n": F.count(F.lit(1)).over(w)}))
    for order, o in (([desc("v")], F.col("v").desc()), (["v"], F.col("v"))):
        _same(with_position(df, ["k"], order, ties=True),
              df.withColumn("pos", (F.rank().over(w.orderBy(o)) - 1).cast("long")))


@pytest.mark.parametrize("keys", [[], ["k"], ["k", "d"]])
def test_running_sum(spark, keys, cut_every):
    df = _data(spark)
    w = Window.partitionBy(*keys).orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    _same(running_sum(df, keys, ["t"], ["d"]), df.withColumn("d_before", F.coalesce(F.sum("d").over(w), F.lit(0))))


@pytest.mark.parametrize("value", [
    lambda i: i, lambda i: 202401010000 + i, lambda i: 10**17 + i, lambda i: f"horse_{i:08d}", lambda i: f"{'same beginning ' * 9}{i:06d}",
    lambda i: 1 + i * 1e-12])
def test_hot_key_is_spread_whatever_its_values(spark, monkeypatch, value):
    monkeypatch.setattr(sequence, "CUT_EVERY", 64)
    kind = {int: "long", str: "string", float: "double"}[type(value(0))]
    df = spark.createDataFrame([(0, value(i)) for i in range(4000)], f"k long, t {kind}")
    sizes = [r["count"] for r in sequence._cut(df, ["k"], ["t"]).groupBy(sequence._B).count().collect()]
    assert len(sizes) > 30 and max(sizes) < 64 * 16
    same_day = df.withColumn("day", F.lit("2024-01-01"))
    assert sequence._cut(same_day, ["k"], ["day", "t"]).select(sequence._B).distinct().count() > 30


def test_one_full_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("t"), F.lit("wide").alias("text"))
    plan = rolling(df, ["k"], ["t"], 5, means={"m": F.col("t")}, count_name="c")._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "_seq_bucket" in line]
    main = [line for line in plan.split("BroadcastExchange")[0].splitlines() if "Exchange hashpartitioning" in line]
    assert wide and len(main) == 1


def test_nothing_runs_while_a_plan_is_built(spark):
    df = _data(spark, 50)
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plans", "plans")
    try:
        x = rolling(df, ["k"], ["t"], 5, means={"m": F.col("v")}, count_name="c")
        running_sum(with_position(x, ["k"], ["t"], total="n"), [], ["t"], ["d"])
        assert status.getJobIdsForGroup("plans") == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
