"""Hand-computed metric cases."""

import math

import pytest
from pyspark.sql import functions as F

from paddock.operators import metrics as M

PRED = "race_id string, horse_id string, predicted_rank long, actual_position long"


def test_top3_overlap_one_third(spark):
    rows = [("r", f"h{i}", i, a) for i, a in zip([1, 2, 3, 4, 5], [1, 4, 5, 2, 3])]
    df = spark.createDataFrame(rows, PRED)
    assert M.top_n_accuracy(df).first()[0] == pytest.approx(1 / 3)


def test_prf_two_thirds(spark):
    rows = [(1, 1), (1, 1), (0, 1), (1, 0), (0, 0)]
    df = spark.createDataFrame(rows, "is_win long, predicted_win long")
    r = df.agg(*M.prf_cols()).first()
    assert r["precision"] == pytest.approx(2 / 3) and r["recall"] == pytest.approx(2 / 3)
    assert r["f1"] == pytest.approx(2 / 3)


def test_log_loss_half(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5)], "is_win long, predicted_prob double")
    assert df.agg(M.log_loss_col()).first()[0] == pytest.approx(0.6931, abs=1e-4)


def test_auc_single_class_and_ties(spark):
    one = spark.createDataFrame([(1, 0.3), (1, 0.9)], "is_win long, predicted_prob double")
    assert M.auc_roc(one).first()[0] == 0.0
    perfect = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, 0.8), (0, 0.2)], "is_win long, predicted_prob double")
    assert M.auc_roc(perfect).first()[0] == 1.0
    tied = spark.createDataFrame([(1, 0.5), (0, 0.5)], "is_win long, predicted_prob double")
    assert M.auc_roc(tied).first()[0] == 0.5


def test_threshold_bucket_exact(spark):
    ps = [0.29, 0.01, 0.0, 0.495, 0.5, 0.57, 0.009999]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    got = [r[0] for r in df.select(M.threshold_bucket(F.col("p"))).collect()]
    assert got == [sum(1 for t in M.THRESHOLDS if t <= p) for p in ps]


def test_best_threshold_lowest_wins_ties(spark):
    df = spark.createDataFrame([(1, 0.3), (0, 0.1), (0, 0.05)], "is_win long, predicted_prob double")
    r = M.best_threshold(df).first()
    assert r["threshold"] == pytest.approx(0.11) and r["f1"] == pytest.approx(1.0)
    none = spark.createDataFrame([(0, 0.3), (0, 0.1)], "is_win long, predicted_prob double")
    assert M.best_threshold(none).first()["threshold"] == pytest.approx(0.01)


def test_relevance_and_group_sizes(spark):
    df = spark.createDataFrame([("a", 1), ("a", 18), ("a", 20), ("b", 2), ("b", 3)], "race_id string, pos long")
    assert [r[0] for r in df.select(M.relevance(F.col("pos"))).collect()] == [18, 1, 1, 17, 16]
    sizes = {r["race_id"]: r["group_size"] for r in M.group_sizes(df).collect()}
    assert sizes == {"a": 3, "b": 2}


def test_ndcg_perfect_and_reversed(spark):
    perfect = spark.createDataFrame([("r", f"h{i}", i, i) for i in range(1, 5)], PRED)
    assert M.ndcg(perfect).first()[0] == pytest.approx(1.0)
    rev = spark.createDataFrame([("r", f"h{i}", i, 5 - i) for i in range(1, 5)], PRED)
    rel = [1, 2, 3, 4]
    dcg = sum(r / math.log2(i + 2) for i, r in enumerate(rel))
    idcg = sum(r / math.log2(i + 2) for i, r in enumerate(sorted(rel, reverse=True)))
    assert M.ndcg(rev).first()[0] == pytest.approx(dcg / idcg)
