"""Queries for model evaluation tables, Spark ML models and scoring."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from paddock.functions.features import feature_columns
from paddock.operators import lambdarank as LR
from paddock.operators import metrics as M
from paddock.operators import models as ML
from paddock.operators import parzen as PZ
from paddock.operators import scoring as SC
from paddock.operators import splits as S
from paddock.operators.fitted import FeaturePipeline
from paddock.operators.isotonic import fit_isotonic
from paddock.plans.bindings import HISTORY_ORDER, HISTORY_ORDER_SQL as ORD, runners, with_entries
from paddock.plans.catalog import query, r6
from paddock.plans.q_history import training
from paddock.plans.q_metrics import PREDS_SQL, THRESHOLD, auc_sql, predictions
from paddock.operators.sequence import rolling
from paddock.session import scratch_dir, staged

RATIO = 0.2
K_FOLDS = 5


def _cls_metrics_sql(src: str, by: str) -> str:
    """Oracle for ``classification_metrics`` (threshold THRESHOLD)."""
    return auc_sql(src, by, name="cauc") + f"""
, cm AS (
  SELECT {by}, avg(CASE WHEN CAST(predicted_prob >= {THRESHOLD} AS BIGINT) = is_win THEN 1.0e0 ELSE 0.0e0 END) AS accuracy,
         sum(CASE WHEN is_win = 1 AND predicted_prob >= {THRESHOLD} THEN 1.0e0 ELSE 0.0e0 END) AS tp,
         sum(CASE WHEN is_win = 0 AND predicted_prob >= {THRESHOLD} THEN 1.0e0 ELSE 0.0e0 END) AS fp,
         sum(CASE WHEN is_win = 1 AND predicted_prob < {THRESHOLD} THEN 1.0e0 ELSE 0.0e0 END) AS fn,
         avg(-(is_win * ln(least(greatest(predicted_prob, 1e-15), 1 - 1e-15))
             + (1 - is_win) * ln(1 - least(greatest(predicted_prob, 1e-15), 1 - 1e-15)))) AS ll,
         count(DISTINCT is_win) AS classes
  FROM {src} GROUP BY {by}
), cm2 AS (
  SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
            CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall FROM cm
), cm3 AS (
  SELECT cm2.*, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1,
         CASE WHEN classes = 2 THEN cauc.auc_roc END AS auc_roc, CASE WHEN classes = 2 THEN ll END AS log_loss
  FROM cm2 JOIN cauc USING ({by})
), clong AS (
""" + "\n  UNION ALL ".join(f"SELECT {by}, '{m}' AS metric, {m} AS value FROM cm3"
                         for m in ["accuracy", "precision", "recall", "f1", "auc_roc", "log_loss"]) + "\n)"


SPLIT_SQL = f"""
, pos AS (SELECT *, row_number() OVER (ORDER BY {ORD}) AS rn, count(*) OVER () AS n FROM preds),
sp AS (SELECT *, CASE WHEN rn <= floor(n * {1 - RATIO}) THEN 'train' ELSE 'validation' END AS split FROM pos)"""


@query("split_metrics", with_entries(PREDS_SQL + SPLIT_SQL + _cls_metrics_sql("sp", "split")
                                     + "\nSELECT split, metric, round(value, 6) AS value FROM clong WHERE value IS NOT NULL"))
def q_split_metrics(spark, sf):
    """Train and validation metrics of the scored rows (temporal split)."""
    p = S.temporal_split(predictions(spark, sf), HISTORY_ORDER, RATIO)
    m = ML.classification_metrics(p, by=["split"], threshold=THRESHOLD)
    return m.select("split", "metric", r6("value").alias("value"))


FOLD_SQL = f"""
, fpos AS (SELECT *, row_number() OVER (ORDER BY {ORD}) - 1 AS p, count(*) OVER () AS n FROM preds),
ff AS (SELECT *, n // {K_FOLDS + 1} AS size, n - {K_FOLDS} * (n // {K_FOLDS + 1}) AS first FROM fpos),
folds AS (SELECT *, CAST(floor((p - first) / size) AS BIGINT) AS test_fold FROM ff WHERE size > 0 AND p >= first)"""


@query("cv_summary", with_entries(PREDS_SQL + FOLD_SQL + _cls_metrics_sql("folds", "test_fold") + """
SELECT metric, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, CAST(count(*) AS BIGINT) AS folds
FROM clong WHERE value IS NOT NULL GROUP BY metric"""))
def q_cv_summary(spark, sf):
    """Per-fold metrics on expanding time folds, then mean and population std."""
    f = S.time_folds(predictions(spark, sf), HISTORY_ORDER, K_FOLDS).filter(F.col("test_fold").isNotNull())
    per_fold = ML.classification_metrics(f, by=["test_fold"], threshold=THRESHOLD)
    c = ML.cv_summary(per_fold)
    return c.select("metric", r6("mean").alias("mean"), r6("std").alias("std"), "folds")


@query("score_rank", with_entries(PREDS_SQL + """
SELECT race_id, horse_id, CAST(ln AS BIGINT) AS ln, round(predicted_prob, 6) AS win_probability,
       CAST(rank() OVER (PARTITION BY race_id ORDER BY predicted_prob DESC) AS BIGINT) AS rank FROM preds"""))
def q_score_rank(spark, sf):
    """J2 on a fixed score: ties share the lowest rank."""
    p = predictions(spark, sf).withColumnRenamed("predicted_prob", "win_probability")
    r = SC.rank_scores(p)
    return r.select("race_id", "horse_id", F.col("ln").cast("long").alias("ln"),
                    r6("win_probability").alias("win_probability"), "rank")


@query("score_audit", with_entries(PREDS_SQL + """
SELECT CAST(count(DISTINCT race_id) AS BIGINT) AS n_races, CAST(count(*) AS BIGINT) AS n_rows,
       'deterministic' AS model_name, 'latest' AS model_version FROM preds"""))
def q_score_audit(spark, sf):
    """Audit columns and the scoring summary."""
    a = SC.audit(predictions(spark, sf), "deterministic")
    s = SC.summary(a)
    names = a.select("model_name", "model_version").limit(1)     # constant columns
    return s.withColumn("_k", F.lit(0)).join(names.withColumn("_k", F.lit(0)), "_k").drop("_k")


# -- Spark ML paths: scores depend on the library, so the oracles check what is
# exact: which rows are scored, that probabilities are probabilities, that ranks
# follow scores, counts, names, and that a model beats chance where one can learn.
VALID_SQL = f"""
, pos AS (SELECT *, row_number() OVER (ORDER BY {ORD}) AS rn, count(*) OVER () AS n FROM entries
          WHERE finish_position IS NOT NULL),
va AS (SELECT * FROM pos WHERE rn > floor(n * {1 - RATIO})),
tr AS (SELECT * FROM pos WHERE rn <= floor(n * {1 - RATIO}))"""
KEYS_SQL = "race_id, horse_id, CAST(ln AS BIGINT) AS ln"


def _keys():
    return ["race_id", "horse_id", F.col("ln").cast("long").alias("ln")]


def _is_prob(c):
    return F.coalesce(F.col(c).between(0.0, 1.0), F.lit(False))


def informative(df, cols):
    """The feature columns with a value in some row of ``df`` (one aggregate)."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in cols]).first()
    return [c for c in cols if counts[c]]


def _split_frame(spark, sf):
    """The entries are written once, narrow: the split reads them for the days' counts and
    on both sides of the cut, the histories, which keep its label, for their cuts and rows."""
    rows = staged(runners(spark, sf).filter(F.col("finish_position").isNotNull()), "runners")
    return training(spark, sf, S.temporal_split(rows, HISTORY_ORDER, RATIO))


def _model_data(spark, sf):
    """Feature frame fitted on the training split; (train, validation, feature columns)."""
    t = _split_frame(spark, sf)
    fm = FeaturePipeline(["race", "horse", "jockey", "running_style"]).fit(t.filter(F.col("split") == "train"))
    cols = feature_columns(fm.transform(t))
    # iterative fits read their input several times: materialise the narrow model input once
    x = staged(fm.transform(t).select("race_id", "horse_id", "ln", "race_date", "jockey_id", "price", "ship",
                                      "finish_position", "is_win", "split", *cols), "model-data")
    tr = x.filter(F.col("split") == "train")
    return tr, x.filter(F.col("split") == "validation"), informative(tr, cols)


@query("gbt_scores", with_entries(VALID_SQL + f"""
SELECT {KEYS_SQL}, CAST(finish_position = 1 AS BIGINT) AS is_win, true AS is_probability FROM va"""))
def q_gbt_scores(spark, sf):
    """GBT winner classifier trained on the training split, scored on validation."""
    tr, va, cols = _model_data(spark, sf)
    s = ML.predict_proba(ML.fit_classifier(tr, cols, "gbt", maxIter=20, maxDepth=4), va, cols)
    return s.select(*_keys(), "is_win", _is_prob("predicted_prob").alias("is_probability"))


@query("calibrated_scores", with_entries(VALID_SQL + f"""
SELECT {KEYS_SQL}, true AS is_probability, true AS keeps_order FROM va"""))
def q_calibrated_scores(spark, sf):
    """Isotonic calibration fitted on the last 20% of the training rows;
    calibrated values never fall while the raw score rises."""
    tr, va, cols = _model_data(spark, sf)
    roles = S.calibration_holdout(tr.withColumn("period", F.lit(0)), HISTORY_ORDER, 0.2)
    model = ML.fit_classifier(roles.filter(F.col("role") == "fit"), cols, "logistic")
    hold = ML.predict_proba(model, roles.filter(F.col("role") == "calibration"), cols)
    cal = ML.calibrator(hold, "isotonic")
    out = ML.calibrate(cal, ML.predict_proba(model, va, cols)).select(*_keys(), "predicted_prob", "calibrated_prob")
    before = rolling(out, [], ["predicted_prob", "race_id", "horse_id", "ln"], 1, lags={"_prev": F.col("calibrated_prob")})
    rises = F.coalesce(F.col("calibrated_prob") >= F.col("_prev") - 1e-9, F.lit(True))
    return before.select("race_id", "horse_id", "ln", (_is_prob("predicted_prob") & _is_prob("calibrated_prob")).alias("is_probability"),
                         rises.alias("keeps_order"))


SCORE_STEPS = 128


@query("isotonic_fit", with_entries(PREDS_SQL + f"""
, g AS (SELECT floor(predicted_prob * {SCORE_STEPS}) / {SCORE_STEPS} AS score, sum(is_win) AS s, count(*) AS n FROM preds GROUP BY 1),
c AS (SELECT *, row_number() OVER (ORDER BY score) AS i, sum(s) OVER (ORDER BY score) AS cs, sum(n) OVER (ORDER BY score) AS cn FROM g),
m AS (SELECT a.i AS a, b.i AS b, CAST(b.cs - a.cs + a.s AS DOUBLE) / CAST(b.cn - a.cn + a.n AS DOUBLE) AS mean
      FROM c a JOIN c b ON a.i <= b.i),
f AS (SELECT c.score, c.n, m.a, min(m.mean) AS low FROM c JOIN m ON m.a <= c.i AND m.b >= c.i GROUP BY c.score, c.n, m.a)
SELECT score, CAST(n AS BIGINT) AS n_entries, round(max(low), 6) AS calibrated_prob FROM f GROUP BY score, n"""))
def q_isotonic_fit(spark, sf):
    """The fitted calibration itself, by score step, on all scored entries (the SQL
    takes its definition: the largest over starts of the least mean over ends)."""
    p = predictions(spark, sf).select((F.floor(F.col("predicted_prob") * SCORE_STEPS) / SCORE_STEPS).alias("score"), "is_win")
    p = staged(p, "isotonic-scores")
    cal = fit_isotonic(p, "score", "is_win")
    return (cal.transform(p.groupBy("score").agg(F.count(F.lit(1)).alias("n_entries")))
               .withColumn("calibrated_prob", r6("calibrated_prob")))


@query("rank_regression", with_entries(VALID_SQL + """
SELECT race_id, count(*) AS n_entries, true AS ranks_complete, true AS follows_score FROM va GROUP BY race_id"""))
def q_rank_regression(spark, sf):
    """I5 + I7 + H6: regress relevance, rank inside races by the score; per
    race the ranks are 1..n and fall with the score."""
    from paddock.operators.backtest import predicted_rank
    tr, va, cols = _model_data(spark, sf)
    tr = tr.withColumn("relevance", M.relevance(F.col("finish_position")))
    x, _ = ML.model_frame(va, cols)
    s = ML.fit_ranker(tr, cols, maxIter=20, maxDepth=4).transform(x).select("race_id", "horse_id", "ln", "rank_score")
    r = predicted_rank(s, prob="rank_score", tie_break=["horse_id", "ln"])
    nxt = rolling(r, ["race_id"], ["predicted_rank"], 1, lags={"_prev": F.col("rank_score")})
    return nxt.groupBy("race_id").agg(
        F.count(F.lit(1)).alias("n_entries"),
        ((F.count_distinct("predicted_rank") == F.count(F.lit(1))) & (F.max("predicted_rank") == F.count(F.lit(1)))).alias("ranks_complete"),
        F.min(F.coalesce(F.col("_prev") >= F.col("rank_score"), F.lit(True))).alias("follows_score"))


LISTWISE_ROUNDS = 10


@query("listwise_ranking", with_entries(VALID_SQL + """
SELECT race_id, count(*) AS n_entries, true AS ranks_complete, true AS follows_score FROM va GROUP BY race_id"""))
def q_listwise_ranking(spark, sf):
    """Boosted trees on NDCG lambda gradients; per race the ranks are 1..n and fall with the score."""
    from paddock.operators.backtest import predicted_rank
    tr, va, cols = _model_data(spark, sf)
    tr = tr.withColumn("relevance", M.relevance(F.col("finish_position")))
    model = LR.fit_lambdarank(tr, cols, ties=["horse_id", "ln"], rounds=LISTWISE_ROUNDS, depth=4, step=0.1)
    s = staged(model.transform(va).select("race_id", "horse_id", "ln", "rank_score"), "listwise-scores")
    r = predicted_rank(s, prob="rank_score", tie_break=["horse_id", "ln"])
    nxt = r.withColumn("_prev", F.lag("rank_score").over(Window.partitionBy("race_id").orderBy("predicted_rank")))
    return nxt.groupBy("race_id").agg(
        F.count(F.lit(1)).alias("n_entries"),
        ((F.count_distinct("predicted_rank") == F.count(F.lit(1))) & (F.max("predicted_rank") == F.count(F.lit(1)))).alias("ranks_complete"),
        F.min(F.coalesce(F.col("_prev") >= F.col("rank_score"), F.lit(True))).alias("follows_score"))


@query("feature_importances")
def q_feature_importances(spark, sf):
    """The importances themselves: (feature, importance, rank) of boosted trees, the 20 highest."""
    tr, _, cols = _model_data(spark, sf)
    top = ML.importances(spark, ML.fit_classifier(tr, cols, "gbt", maxIter=10, maxDepth=4), cols, top=20)
    w = Window.orderBy(F.col("importance").desc(), "feature")                # over 20 rows
    return top.withColumn("rank", F.row_number().over(w).cast("long"))


@query("importances", "SELECT 2 AS n_models, true AS ranked, true AS shares, true AS ranker_summary")
def q_importances(spark, sf):
    """I9 + I10: top-20 importances of two models and of their ensemble: ranked,
    non-negative, adding up to at most one; the ranker's score summary."""
    tr, va, cols = _model_data(spark, sf)
    gbt = ML.fit_classifier(tr, cols, "gbt", maxIter=10, maxDepth=4)
    rank = ML.fit_ranker(tr.withColumn("relevance", M.relevance(F.col("finish_position"))), cols, maxIter=10, maxDepth=4)
    one, two = (ML.importances(spark, m, cols, top=20) for m in (gbt, rank))
    both = ML.ensemble_importances([one, two], [1.0, 1.0])
    x, _ = ML.model_frame(va, cols)
    scores = ML.regression_summary(rank.transform(x)).select(
        (F.col("pred_mean").isNotNull() & (F.col("pred_std") >= 0)).alias("ranker_summary"))
    total = both.agg(F.sum("importance").alias("t"), F.min("importance").alias("low"), F.count(F.lit(1)).alias("n"))
    return total.withColumn("_k", F.lit(0)).join(scores.withColumn("_k", F.lit(0)), "_k").select(
        F.lit(2).alias("n_models"), (F.col("n") >= 1).alias("ranked"),
        ((F.col("low") >= 0) & (F.col("t") <= 1 + 1e-6)).alias("shares"), "ranker_summary")


@query("cross_validate", with_entries(VALID_SQL + f"""
, k AS (SELECT count(*) AS n, count(*) // {K_FOLDS + 1} AS size FROM tr)
SELECT CAST(f AS BIGINT) AS test_fold, s || '_' || m AS metric,
       CAST(CASE WHEN s = 'train' THEN n - ({K_FOLDS} - f) * size ELSE size END AS BIGINT) AS n_rows,
       CAST({K_FOLDS} AS BIGINT) AS folds, true AS value_valid, true AS summary_valid
FROM k, range({K_FOLDS}) a(f), (VALUES ('train'), ('val')) x(s),
     (VALUES ('accuracy'), ('precision'), ('recall'), ('f1'), ('auc_roc'), ('log_loss')) y(m)"""))
def q_cross_validate(spark, sf):
    """I11 with a fresh model per fold: train and test metrics of every fold, and
    their mean and population std."""
    tr, _, cols = _model_data(spark, sf)
    per_fold = staged(ML.cross_validate(tr.drop("split"), cols, HISTORY_ORDER, K_FOLDS, maxIter=10, maxDepth=4), "cv-metrics")
    total = per_fold.groupBy("metric").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    summary = ML.cv_summary(per_fold).join(total, "metric").select(
        "metric", "folds", (F.col("mean").between(F.col("low") - 1e-9, F.col("high") + 1e-9) & (F.col("std") >= 0)).alias("summary_valid"))
    return per_fold.join(summary, "metric").select(
        "test_fold", "metric", "n_rows", "folds", F.when(F.col("metric").endswith("log_loss"), F.col("value") >= 0).otherwise(
            _is_prob("value")).alias("value_valid"), "summary_valid")


#: Candidates of the registered search. The operator's defaults are 50 over 3
#: folds; this query fits fewer, since it is run over and over.
QUERY_CANDIDATES = 4


@query("param_search", f"""
SELECT CAST(c AS BIGINT) AS candidate, CAST(f AS BIGINT) AS fold, true AS score_valid, true AS one_best
FROM range({QUERY_CANDIDATES}) a(c), range(3) b(f)""")
def q_param_search(spark, sf):
    """Seeded random search, each candidate scored on 3 expanding time folds."""
    tr, _, cols = _model_data(spark, sf)
    folds = S.time_folds(tr, HISTORY_ORDER, n_splits=3)
    space = {k: v for k, v in ML.LOGISTIC_SPACE.items()}
    res = ML.param_search(tr, cols, folds, ML.random_candidates(QUERY_CANDIDATES, seed=7, space=space), metric="auc_roc", kind="logistic")
    best = ML.best_params(res).select(F.lit(0).alias("_k"), F.col("params").isNotNull().alias("one_best"))  # one row
    return res.withColumn("_k", F.lit(0)).join(F.broadcast(best), "_k").select(
        "candidate", "fold", _is_prob("score").alias("score_valid"), "one_best")


TUNE_TRIALS, TUNE_FOLDS = 4, 2


@query("adaptive_search", f"""
SELECT CAST(c AS BIGINT) AS candidate, CAST(f AS BIGINT) AS fold, 9 AS n_params, true AS score_valid
FROM range({TUNE_TRIALS}) a(c), range({TUNE_FOLDS}) b(f)""")
def q_adaptive_search(spark, sf):
    """Parzen search over nine parameters of boosted trees, few and small
    trees, trials and folds (the operator's default is 50 x 3 of up to 1,000 trees)."""
    tr, _, cols = _model_data(spark, sf)
    folds = S.time_folds(tr, HISTORY_ORDER, n_splits=TUNE_FOLDS)
    space = PZ.SPACE | {"maxIter": PZ.Whole(3, 6), "maxDepth": PZ.Whole(2, 4), "maxBins": PZ.Whole(32, 64)}
    res = PZ.tune(tr, cols, folds, space, n=TUNE_TRIALS, batch=2, start=2)
    return res.select("candidate", "fold", F.size(F.json_object_keys("params")).alias("n_params"), _is_prob("score").alias("score_valid"))


def _registry(spark):
    return ML.ModelRegistry(spark, scratch_dir(spark, "registry"))


_V = [(0.01, "2026-01-05T10:00:01"), (0.1, "2026-01-05T10:00:10")]


def _versions_sql() -> str:
    """Version strings from their hashes (sha256 of name, parameters and time)."""
    params = [json.dumps({"regParam": p}) for p, _ in _V]
    names = [f"'20260105_' || substr(sha256('winner_lr|{p}|{at}'), 1, 8)" for p, (_, at) in zip(params, _V, strict=True)]
    rows = " UNION ALL ".join(f"SELECT {v} AS version, '{p}' AS params" for v, p in zip(names, params, strict=True))
    return f"""
SELECT 'winner_lr' AS name, version, 'logistic' AS model_type, params, {names[-1]} AS latest_version FROM ({rows})"""


@query("model_versions", _versions_sql())
def q_model_versions(spark, sf):
    """Two saved versions, listed, and the latest per name."""
    tr, va, cols = _model_data(spark, sf)
    reg = _registry(spark)
    for reg_param, at in _V:
        m = ML.fit_classifier(tr, cols, "logistic", regParam=reg_param)
        reg.save(m, "winner_lr", "logistic", {"regParam": reg_param}, {"n_features": len(cols)}, now=dt.datetime.fromisoformat(at))
    latest = reg.latest().withColumnRenamed("version", "latest_version")
    v = reg.versions("winner_lr").select("name", "version", "model_type", "params")
    return v.join(latest, "name")


@query("train_step", """
SELECT split, metric, true AS value_valid, true AS threshold_valid
FROM (VALUES ('train'), ('validation')) s(split),
     (VALUES ('accuracy'), ('precision'), ('recall'), ('f1'), ('auc_roc'), ('log_loss')) m(metric)""")
def q_train_step(spark, sf):
    """Fit on the training split, calibrate on the first half of the
    validation rows, choose the threshold on the second, then train and
    validation metrics of the calibrated probabilities."""
    tr, va, cols = _model_data(spark, sf)
    m, t = ML.train_step(tr, va, cols, HISTORY_ORDER, maxIter=20, maxDepth=4)
    return m.select("split", "metric", F.when(F.col("metric") == "log_loss", F.col("value") >= 0).otherwise(
        _is_prob("value")).alias("value_valid"), F.lit(0.0 < t < 0.5).alias("threshold_valid"))


FIT_PERIODS = dict(train_window=730, test_window=365, step=365)


@query("backtest_fitted", with_entries(f"""
, rng AS (SELECT min(race_date) AS lo, max(race_date) AS hi FROM entries),
c AS (SELECT CAST(unnest(generate_series(lo + 730, hi, INTERVAL 365 DAYS)) AS DATE) AS test_start, lo FROM rng),
p AS (SELECT test_start - 730 AS train_start, test_start - 1 AS train_end, test_start, test_start + 364 AS test_end FROM c),
n AS (SELECT p.*, (SELECT count(*) FROM entries e WHERE e.race_date BETWEEN train_start AND train_end) AS n_train,
             (SELECT count(*) FROM entries e WHERE e.race_date BETWEEN test_start AND p.test_end) AS n_test FROM p)
SELECT row_number() OVER (ORDER BY test_start) - 1 AS period, train_start, train_end, test_start, test_end, n_train, n_test,
       n_test AS n_scored, true AS probabilities, true AS train_before_test
FROM n WHERE n_train > 0 AND n_test > 0"""))
def q_backtest_fitted(spark, sf):
    """H8 with a model per period: fitted, calibrated and thresholded on the
    period's training rows only, scored on its test rows."""
    t = training(spark, sf, staged(runners(spark, sf), "runners"))
    fm = FeaturePipeline(["race", "horse", "jockey", "running_style"]).fit(t)
    cols = feature_columns(fm.transform(t))
    x = staged(fm.transform(t).select("race_id", "horse_id", "ln", "race_date", "jockey_id", "price", "ship",
                                      "is_win", "actual_position", *cols), "backtest-data")
    periods = S.walk_forward_periods(x, **FIT_PERIODS)
    scored = ML.walk_forward(x, periods, cols, HISTORY_ORDER, kind="logistic")
    per = scored.groupBy("period").agg(F.count(F.lit(1)).alias("n_scored"), F.min(_is_prob("predicted_prob")).alias("probabilities"),
                                       F.min(F.col("race_date") > F.col("train_max")).alias("train_before_test"))
    return periods.join(per, "period")


@query("score_batch", with_entries(VALID_SQL + """
SELECT race_id, horse_id, race_date AS predicted_date, true AS is_probability, true AS rank_in_race, 'winner_lr' AS model_name,
       'latest' AS model_version
FROM va"""))
def q_score_batch(spark, sf):
    """Load the latest model and the feature pipeline stored with it, turn
    raw entries into features, score, rank, audit, append to the sink."""
    t = staged(_split_frame(spark, sf), "training")              # read by the fit and by the scoring
    train = t.filter(F.col("split") == "train")
    fm = FeaturePipeline(["race", "horse", "jockey", "running_style"]).fit(train)
    made = fm.transform(train)
    cols = informative(made, feature_columns(made))
    reg = _registry(spark)
    reg.save(ML.fit_classifier(made, cols, "logistic"), "winner_lr", "logistic", {}, {}, pipeline=fm, feature_cols=cols)
    sink = scratch_dir(spark, "predictions")
    SC.batch_predict(reg, "winner_lr", t.filter(F.col("split") == "validation"), sink=sink)
    back = spark.read.parquet(sink)
    return back.select("race_id", "horse_id", "predicted_date", _is_prob("win_probability").alias("is_probability"),
                       (F.col("rank") >= 1).alias("rank_in_race"), "model_name", "model_version")
