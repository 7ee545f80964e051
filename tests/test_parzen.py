"""The Parzen sampler: better than random, reproducible, inside its ranges; a search over real fits."""

import math
import random
import statistics

from pyspark.sql import functions as F

from paddock.operators import models as ML
from paddock.operators import parzen as P
from paddock.operators import splits as S

BOWL = {"a": P.Real(-5, 5), "b": P.Real(1e-4, 10, log=True), "c": P.Whole(1, 100)}


def _bowl(p):
    return -((p["a"] - 2) ** 2 + (math.log10(p["b"]) + 1) ** 2 + ((p["c"] - 70) / 15) ** 2)


def test_better_than_random():
    ours, plain = [], []
    for seed in range(15):
        ours.append(max(s for _, s in P.search(lambda _, b: [_bowl(p) for p in b], BOWL, n=60, batch=4, seed=seed)))
        rnd = random.Random(1000 + seed)
        plain.append(max(_bowl({k: d.value(rnd.random()) for k, d in BOWL.items()}) for _ in range(60)))
    assert statistics.median(ours) > statistics.median(plain) / 2         # both are negative


def test_reproducible_and_inside():
    runs = [P.search(lambda _, b: [-_bowl(p) for p in b], BOWL, n=33, batch=5, seed=3, maximize=False) for _ in range(2)]
    assert runs[0] == runs[1] and len(runs[0]) == 33
    for p, _ in runs[0]:
        assert -5 <= p["a"] <= 5 and 1e-4 <= p["b"] <= 10.0001 and 1 <= p["c"] <= 100 and isinstance(p["c"], int)
    other = P.search(lambda _, b: [0.0] * len(b), BOWL, n=12, seed=4)     # all trials tie
    assert len({str(p) for p, _ in other}) == 12


def test_densities_integrate_to_one():
    for points in ([], [0.0], [0.2, 0.2, 0.9], [0.0, 0.5, 1.0]):
        k = P._density(points)
        assert abs(sum(P._weight(k, (i + 0.5) / 4000) for i in range(4000)) / 4000 - 1) < 1e-3


def test_default_is_nine_parameters_fifty_by_three(spark, monkeypatch):
    monkeypatch.setattr(ML, "param_search", lambda df, cols, folds, cand, *a: spark.createDataFrame(
        [(i, str(sorted(c.items())), f, 0.5) for i, c in enumerate(cand) for f in range(P.FOLDS)], "candidate long, params string, fold long, score double"))
    out = P.tune(None, [], None)
    assert len(P.SPACE) == 9 and out.count() == 50 * 3 and out.select("candidate").distinct().count() == 50


def test_tune_over_fits(spark):
    rnd = random.Random(2)
    rows = [(i, f"2024-01-{1 + i // 40:02d}", x := rnd.random(), float(x + rnd.gauss(0, 0.2) > 0.5)) for i in range(400)]
    df = spark.createDataFrame(rows, "race_id long, race_date string, f double, is_win double").withColumn("race_date", F.to_date("race_date"))
    folds = S.time_folds(df, ["race_date", "race_id"], n_splits=2)
    space = {"regParam": P.Real(1e-3, 1.0, log=True), "maxIter": P.Whole(5, 20)}
    for metric in ("auc_roc", "log_loss", "accuracy"):
        out = P.tune(df, ["f"], folds, space, n=3, batch=2, metric=metric, kind="logistic", start=2).collect()
        assert sorted((r["candidate"], r["fold"]) for r in out) == [(c, f) for c in range(3) for f in range(2)]
        assert all(0 <= r["score"] for r in out)
