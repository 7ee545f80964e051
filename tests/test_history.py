"""Leakage invariants of the history features."""

import datetime as dt

from pyspark.sql import functions as F

from paddock.operators.history import horse_summary, prepare_for_training, strict_date_history

ORDER = ["race_date", "race_id", "horse_id"]


def _races(spark):
    rows = []
    base = dt.date(2020, 1, 1)
    for w in range(30):
        for h in range(6):
            rows.append((f"r{w:02d}", base + dt.timedelta(days=7 * w), f"h{h}", f"j{h % 3}", ((w + h) % 6) + 1, 450.0 + h))
    return spark.createDataFrame(rows, "race_id string, race_date date, horse_id string, jockey_id string, "
                                       "finish_position int, weight double")


def test_first_race_has_no_history_and_counts_grow(spark):
    t = prepare_for_training(_races(spark), ORDER)
    rows = t.filter(F.col("horse_id") == "h0").orderBy("race_date").collect()
    assert rows[0]["num_past_races"] == 0 and rows[0]["avg_finish"] is None
    assert [r["num_past_races"] for r in rows] == list(range(len(rows)))
    assert rows[1]["avg_finish"] == rows[0]["finish_position"]
    assert rows[1]["days_since_last_race"] == 7


def test_history_ignores_current_and_future(spark):
    df = _races(spark)
    t = prepare_for_training(df, ORDER)
    changed = df.withColumn("finish_position", F.when(F.col("race_id") == "r29", F.lit(1))
                            .otherwise(F.col("finish_position")))
    t2 = prepare_for_training(changed, ORDER)
    a = t.filter(F.col("race_id") == "r29").select("horse_id", "avg_finish", "win_rate").collect()
    b = t2.filter(F.col("race_id") == "r29").select("horse_id", "avg_finish", "win_rate").collect()
    assert sorted(a) == sorted(b)


def test_null_outcomes_dropped_and_no_jockey(spark):
    df = spark.createDataFrame([("r1", dt.date(2020, 1, 1), "h1", 1), ("r2", dt.date(2020, 1, 8), "h1", None),
                                ("r3", dt.date(2020, 1, 15), "h1", 2)],
                               "race_id string, race_date date, horse_id string, finish_position int")
    t = prepare_for_training(df, ORDER)
    assert t.count() == 2
    assert t.filter(F.col("jockey_win_rate").isNotNull()).count() == 0


def test_strict_date_shares_history(spark):
    d = dt.date(2020, 1, 1)
    df = spark.createDataFrame([("a", d, "h", 1), ("b", d + dt.timedelta(1), "h", 2), ("c", d + dt.timedelta(1), "h", 3)],
                               "race_id string, race_date date, horse_id string, finish_position int")
    s = strict_date_history(df, ORDER).orderBy("race_id").collect()
    assert s[1]["num_past_races"] == s[2]["num_past_races"] == 1
    assert s[1]["avg_finish"] == s[2]["avg_finish"] == 1.0


def test_summary_takes_latest_n_and_oldest_weight(spark):
    s = horse_summary(_races(spark), ORDER, n_past=5).filter(F.col("horse_id") == "h1").first()
    assert s["num_past_races"] == 5 and str(s["last_race_date"]) == str(dt.date(2020, 1, 1) + dt.timedelta(days=7 * 29))
    assert s["weight"] == 451.0
