"""Fit on train, apply anywhere."""

import datetime as dt

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from paddock.operators.fitted import CategoryEncoder, FeaturePipeline, FeaturePipelineModel, FeatureScaler, as_vector


def test_standard_scale_uses_train_stats(spark):
    train = spark.createDataFrame([(10.0,), (20.0,), (30.0,)], "x double")
    test = spark.createDataFrame([(10.0,), (100.0,), (1000.0,)], "x double")
    m = FeatureScaler(["x"], "standard").fit(train)
    got = [r[0] for r in m.transform(test).select("x_scaled").collect()]
    assert got == pytest.approx([-1.0, 8.0, 98.0])


def test_minmax_zero_range_guard(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    m = FeatureScaler(["x"], "minmax").fit(df)
    assert m.stats["x"].max == 6.0
    zero = spark.createDataFrame([(-1.0,), (0.0,)], "x double")
    assert FeatureScaler(["x"], "minmax").fit(zero).stats["x"].max == 0.0   # a max of 0 stays 0


def test_label_encode_sorted_and_unseen(spark):
    train = spark.createDataFrame([("Tokyo",), ("Kyoto",), ("Tokyo",), ("Hanshin",)], "c string")
    m = CategoryEncoder(["c"], "label").fit(train)
    assert sorted(map(tuple, m.transform(train).collect())) == [("Hanshin", 0), ("Kyoto", 1), ("Tokyo", 2), ("Tokyo", 2)]
    new = spark.createDataFrame([("Sapporo",), (None,)], "c string")
    assert [r[0] for r in m.transform(new).select("c_encoded").collect()] == [-1, -1]


def test_onehot(spark):
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    m = CategoryEncoder(["c"], "onehot").fit(train)
    rows = m.transform(spark.createDataFrame([("b",), ("z",), (None,)], "c string")).collect()
    assert [(r["c_a"], r["c_b"]) for r in rows] == [(0, 1), (0, 0), (None, None)]


def test_transform_before_fit_raises(spark):
    df = spark.createDataFrame([(1,)], "distance int")
    with pytest.raises(RuntimeError):
        FeaturePipeline(["race"], scaler=FeatureScaler(["feat_distance"])).transform(df)
    assert "feat_distance" in FeaturePipeline(["race"]).transform(df).columns


def test_label_encode_many_categories(spark):
    df = spark.range(150_000).select(F.concat(F.lit("c"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("c"), "id")
    m = CategoryEncoder(["c"], "label").fit(df)
    assert m.transform(df).filter(F.col("c_encoded") != F.col("id")).count() == 0


def test_sparse_onehot_of_many_categories(spark, tmp_path):
    df = spark.range(100_000).select(F.concat(F.lit("horse_"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("c"), "id")
    p = FeaturePipeline([], CategoryEncoder(["c"], "sparse")).fit(df)
    p.save(spark, str(tmp_path / "sparse"))
    for model in (p, FeaturePipelineModel.load(spark, str(tmp_path / "sparse"))):
        out = model.transform(df)
        assert out.columns == ["c", "id", "c_onehot"]
        wrong = (F.col("c_onehot.size") != 100_000) | (F.col("c_onehot.indices") != F.array(F.col("id").cast("int")))
        assert out.filter(wrong).count() == 0
    new = spark.createDataFrame([("horse_0000007",), ("other",), (None,)], "c string")
    got = [r[0] for r in p.encoder.transform(new).orderBy("c").select("c_onehot").collect()]
    assert got == [None, (100_000, [7], [1.0]), (100_000, [], [])]
    empty = CategoryEncoder(["c"], "sparse").fit(df.limit(0)).transform(new).filter("c is not null").select("c_onehot").distinct().collect()
    assert [tuple(r[0]) for r in empty] == [(0, [], [])]


def test_sparse_onehot_feeds_a_model(spark):
    rows = [(f"k{i % 50}", float(i % 50 < 10)) for i in range(1000)]
    df = spark.createDataFrame(rows, "c string, y double")
    x = CategoryEncoder(["c"], "sparse").fit(df).transform(df).withColumn("features", as_vector("c_onehot"))
    first = x.first()["features"]
    assert type(first).__name__ == "SparseVector" and first.size == 50 and first.numNonzeros() == 1
    fit = LogisticRegression(labelCol="y", regParam=0.001).fit(x)
    assert fit.transform(x).filter("prediction != y").count() == 0


def test_pipeline_state_survives_a_reload(spark, tmp_path):
    df = spark.createDataFrame([("t", 1000, dt.date(2024, 1, 1)), ("u", 2000, dt.date(2024, 2, 1))],
                               "track_type string, distance int, last_race_date date")
    p = FeaturePipeline(["race"], CategoryEncoder(["track_type"]), FeatureScaler(["feat_distance"]),
                        {"as_of": dt.date(2024, 3, 1)}).fit(df)
    p.save(spark, str(tmp_path / "pipe"))
    back = FeaturePipelineModel.load(spark, str(tmp_path / "pipe"))
    assert back.options == p.options
    a, b = p.transform(df), back.transform(df)
    assert a.columns == b.columns and a.exceptAll(b).count() == 0
