"""Feature tables clustered by race: pruned loads, joins and aggregates in place."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from paddock.sources import sinks as K


def _plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_buckets_are_pruned_and_joins_need_no_exchange(spark, tmp_path):
    def frame(n):
        return spark.range(n).select((F.col("id") % 500).alias("race_id"), F.col("id").alias("horse_id"), (F.col("id") * 0.5).alias("x"))

    assert K.save_feature_table(frame(3000), "clustered_a", str(tmp_path / "a"), buckets=8, mode="truncate")
    assert K.save_feature_table(frame(1000), "clustered_b", str(tmp_path / "b"), buckets=8, mode="truncate")
    assert K.save_feature_table(frame(200), "clustered_b", buckets=8) and not K.save_feature_table(frame(0), "clustered_b", buckets=8)
    assert spark.table("clustered_b").count() == 1200

    some = K.load_feature_table(spark, "clustered_a", ["race_id", "x"], [7, 7, 400, 9999])
    assert some.columns == ["race_id", "x"] and some.count() == 12
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")      # so that the plan names the buckets
    chosen = re.search(r"SelectedBucketsCount: (\d+) out of 8", _plan(K.load_feature_table(spark, "clustered_a", ["race_id", "x"], [7, 7, 400, 9999])))
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert chosen and int(chosen.group(1)) <= 3

    a, b = (K.load_feature_table(spark, f"clustered_{t}") for t in "ab")
    joined = a.hint("merge").join(b.select("race_id", F.col("x").alias("y")), "race_id").groupBy("race_id").count()
    assert "Exchange" not in _plan(joined) and "SortMergeJoin" in _plan(joined)
    assert joined.agg(F.sum("count")).first()[0] == sum(6 * (3 if r < 200 else 2) for r in range(500))

    ids = spark.createDataFrame([(3,), (3,), (499,), (None,)], "race_id long")
    assert K.load_feature_table(spark, "clustered_a", None, ids).count() == 12
    for t in "ab":
        spark.sql(f"DROP TABLE clustered_{t}")
