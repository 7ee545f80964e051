"""The model path: learnable targets, calibration, walk-forward fits, registry."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from paddock.operators import metrics as M
from paddock.operators import models as ML
from paddock.operators.fitted import FeaturePipeline
from paddock.operators.scoring import batch_predict
from paddock.operators.splits import walk_forward_periods

ORDER = ["race_date", "race_id", "horse_id"]
COLS = ["feat_a", "feat_b"]


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(5)
    rows = []
    for d in range(120):
        for h in range(6):
            a = rnd.random() if rnd.random() > 0.05 else None
            win = int((a or 0.5) + 0.3 * rnd.random() > 0.9)
            rows.append((f"r{d}", h, dt.date(2023, 1, 1) + dt.timedelta(days=3 * d), a, rnd.random(), win, h + 1))
    return spark.createDataFrame(rows, "race_id string, horse_id long, race_date date, feat_a double, feat_b double, "
                                       "is_win int, actual_position int")


def test_classifier_learns_and_calibration_keeps_probabilities(spark, data):
    train, test = data.filter("race_date < '2023-10-01'"), data.filter("race_date >= '2023-10-01'")
    for kind, params in (("gbt", {"maxIter": 5, "maxDepth": 3}), ("logistic", {})):
        model = ML.fit_classifier(train, COLS, kind, **params)
        s = ML.predict_proba(model, test, COLS)
        assert M.auc_roc(s).first()["auc_roc"] > 0.7
        for method in ("isotonic", "sigmoid"):
            out = ML.calibrate(ML.calibrator(ML.predict_proba(model, train, COLS), method), s)
            assert out.filter(~F.col("calibrated_prob").between(0, 1)).count() == 0 and out.count() == test.count()


def test_train_step_reports_both_sides(spark, data):
    cut = data.withColumn("split", F.when(F.col("race_date") < "2023-09-01", "train").otherwise("validation"))
    m, t = ML.train_step(cut.filter("split = 'train'"), cut.filter("split = 'validation'"), COLS, ORDER, kind="logistic")
    got = {(r["split"], r["metric"]): r["value"] for r in m.collect()}
    assert 0 < t < 0.5 and got["validation", "auc_roc"] > 0.7 and got["train", "auc_roc"] > 0.7


def test_cross_validate_fits_every_fold(spark, data):
    got = ML.cross_validate(data, COLS, ORDER, 3, kind="logistic", threshold=0.3)
    assert {(r["metric"], r["folds"]) for r in ML.cv_summary(got).collect()} == {
        (f"{s}_{m}", 3) for s in ("train", "val") for m in ("accuracy", "precision", "recall", "f1", "auc_roc", "log_loss")}
    got = {(r["test_fold"], r["metric"]): r for r in got.collect()}
    rows = sorted(data.collect(), key=lambda r: (r["race_date"], r["race_id"], r["horse_id"]))
    for f in range(3):
        parts = [spark.createDataFrame(x, data.schema) for x in (rows[:180 * (f + 1)], rows[180 * (f + 1):180 * (f + 2)])]
        model = ML.fit_classifier(parts[0], COLS, "logistic")
        for side, part in zip(("train", "val"), parts, strict=True):
            for m in ML.classification_metrics(ML.predict_proba(model, part, COLS), threshold=0.3).collect():
                r = got[f, f"{side}_{m['metric']}"]
                assert r["n_rows"] == part.count() and r["value"] == pytest.approx(m["value"], abs=1e-6)


def test_walk_forward_never_sees_the_test_window(spark, data):
    periods = walk_forward_periods(data, train_window=120, test_window=60, step=60)
    out = ML.walk_forward(data, periods, COLS, ORDER, kind="logistic").collect()
    want = {r["period"]: r["n_test"] for r in periods.collect()}
    assert len(want) >= 3
    for p, n in want.items():
        rows = [r for r in out if r["period"] == p]
        assert len(rows) == n
        assert all(r["race_date"] > r["train_max"] and 0 <= r["predicted_prob"] <= 1 and r["predicted_win"] in (0, 1) for r in rows)


def test_search_defaults_and_best(spark):
    c = ML.random_candidates()
    assert len(c) == 50 and all(set(x) == set(ML.SEARCH_SPACE) for x in c)
    res = spark.createDataFrame([(0, "a", 0, 0.5), (0, "a", 1, 0.7), (1, "b", 0, 0.9), (1, "b", 1, 0.4)],
                                "candidate long, params string, fold long, score double")
    assert ML.best_params(res).first()["params"] == "b"


def test_registry_serves_the_stored_pipeline(spark, data, tmp_path):
    raw = data.withColumnsRenamed({"feat_a": "distance", "feat_b": "race_number"})
    fm = FeaturePipeline(["race"]).fit(raw)
    made = fm.transform(raw)
    cols = [c for c, n in made.agg(*[F.count(c).alias(c) for c in made.columns if c.startswith("feat_")]).first().asDict().items() if n]
    reg = ML.ModelRegistry(spark, str(tmp_path / "reg"))
    reg.save(ML.fit_classifier(made, cols, "logistic"), "m", "logistic", {}, {}, pipeline=fm, feature_cols=cols)
    out = batch_predict(reg, "m", raw, sink=str(tmp_path / "sink"))
    assert out.count() == raw.count() and out.filter("win_probability < 0 or win_probability > 1 or rank < 1").count() == 0
    assert spark.read.parquet(str(tmp_path / "sink")).count() == raw.count()


def test_auc_with_huge_counts(spark):
    """Products of class counts beyond a long do not overflow."""
    df = spark.createDataFrame([(0.9, 5 * 10**9, 10**9), (0.1, 10**9, 5 * 10**9)], "s double, pos long, neg long")
    neg = F.col("neg").cast("double")
    assert df.select((neg * F.col("pos")).alias("x")).agg(F.max("x")).first()[0] == 5e18
    rows = spark.createDataFrame([(0.9, 1), (0.9, 0), (0.1, 0)], "predicted_prob double, is_win int")
    assert M.auc_roc(rows).first()["auc_roc"] == pytest.approx(0.75)
