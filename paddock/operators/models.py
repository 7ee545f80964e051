"""Spark ML models, calibration, ensembles and model search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def effective_weights(weights: Sequence[float] | None, n_models: int) -> list[float]:
    """Weights normalised to sum 1; uniform when absent or of the wrong length."""
    if weights and len(weights) == n_models:
        total = float(sum(weights))
        return [w / total for w in weights]
    return [1.0 / n_models] * n_models if n_models else []


def ensemble(probs: Sequence[Column], weights: Sequence[float] | None = None,
             class_threshold: float = 0.5) -> tuple[Column, Column]:
    """I8: weighted mean of positive-class probabilities and of class outputs.

    Model outputs sit side by side as columns, so the ensemble is a projection
    (no shuffle).
    """
    w = effective_weights(weights, len(probs))
    prob = sum((F.lit(wi) * p for wi, p in zip(w, probs)), F.lit(0.0))
    cls = sum((F.lit(wi) * (p >= class_threshold).cast("double") for wi, p in zip(w, probs)), F.lit(0.0))
    return prob, cls


# ---------------------------------------------------------------------------
# Spark ML models
import datetime as _dt  # noqa: E402
import functools  # noqa: E402
import hashlib  # noqa: E402
import json  # noqa: E402
import random  # noqa: E402
from dataclasses import dataclass  # noqa: E402

from pyspark.ml import Pipeline, PipelineModel  # noqa: E402
from pyspark.ml.classification import GBTClassifier, LogisticRegression  # noqa: E402
from pyspark.ml.feature import Imputer, VectorAssembler  # noqa: E402
from pyspark.ml.functions import vector_to_array  # noqa: E402
from pyspark.ml.regression import GBTRegressor  # noqa: E402
from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402

from paddock.operators import metrics as _M  # noqa: E402
from paddock.operators.isotonic import fit_isotonic  # noqa: E402
from paddock.session import small_splits, staged  # noqa: E402


def model_frame(df: DataFrame, feature_cols: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Cast features to double and add a missing flag per feature.

    Every entity's first race has null history; GBTs reject NaN and the
    assembler rejects null, so nulls are imputed and the flags keep the
    'missing' signal the reference's boosting library uses natively.
    """
    cols = {f"_x_{c}": F.col(c).cast("double") for c in feature_cols}
    cols.update({f"_m_{c}": F.col(c).isNull().cast("double") for c in feature_cols})
    return df.withColumns(cols), [f"_m_{c}" for c in feature_cols]


def with_missing(train: DataFrame, feature_cols: Sequence[str]) -> list[str]:
    """The feature columns that are null in some row (one aggregate)."""
    n = train.agg(F.count(F.lit(1)), *[F.count(F.col(c)) for c in feature_cols]).first()
    return [c for c, some in zip(feature_cols, n[1:], strict=True) if some < n[0]]


def _stages(feature_cols: Sequence[str], estimator, flagged: Sequence[str]) -> list:
    """``flagged``: the columns missing somewhere in the fitted rows. Any other flag is 0 in
    all of them: no tree splits on it and its weight is 0, so it is left out of what a fit
    holds of every row."""
    xs = [f"_x_{c}" for c in feature_cols]
    imputed = [f"_i_{c}" for c in feature_cols]
    flags = [f"_m_{c}" for c in flagged]
    return [Imputer(inputCols=xs, outputCols=imputed, strategy="mean"),
            VectorAssembler(inputCols=imputed + flags, outputCol="features", handleInvalid="keep"),
            estimator]


def classifier(kind: str = "gbt", label: str = "is_win", **params):
    """GBT (default) or logistic regression producing ``probability``."""
    if kind == "gbt":
        p = dict(maxIter=500, maxDepth=5, stepSize=0.05, seed=42, subsamplingRate=0.8)
        p.update(params)
        return GBTClassifier(labelCol=label, featuresCol="features", **p)
    p = dict(maxIter=50, regParam=0.01)
    p.update(params)
    return LogisticRegression(labelCol=label, featuresCol="features", **p)


def fit(stages: Sequence, x: DataFrame) -> PipelineModel:
    """Fit the stages in tasks of bounded size, however large the files are."""
    with small_splits(x.sparkSession):
        return Pipeline(stages=list(stages)).fit(x)


def fit_preparation(train: DataFrame, feature_cols: Sequence[str]) -> PipelineModel:
    """Imputer and assembler fitted on the rows, for models that share them."""
    return fit(_stages(feature_cols, None, with_missing(train, feature_cols))[:-1], model_frame(train, feature_cols)[0])


def fit_classifier(train: DataFrame, feature_cols: Sequence[str], kind: str = "gbt",
                   label: str = "is_win", prepared: PipelineModel | None = None, **params) -> PipelineModel:
    """``prepared``: the ``fit_preparation`` of the same rows and columns, if there is one."""
    x, _ = model_frame(train, feature_cols)
    x = x.withColumn(label, F.col(label).cast("double"))
    before = prepared.stages if prepared else _stages(feature_cols, None, with_missing(train, feature_cols))[:-1]
    return fit([*before, classifier(kind, label, **params)], x)


def predict_proba(model: PipelineModel, df: DataFrame, feature_cols: Sequence[str],
                  out: str = "predicted_prob") -> DataFrame:
    """Score rows; ``out`` is the positive-class probability."""
    x, _ = model_frame(df, feature_cols)
    p = model.transform(x)
    drop = [c for c in p.columns if c.startswith(("_x_", "_m_", "_i_"))] + \
        ["features", "rawPrediction", "probability", "prediction"]
    return p.withColumn(out, vector_to_array("probability")[1]).drop(*[c for c in drop if c in p.columns])


def calibrator(holdout: DataFrame, method: str = "isotonic", prob: str = "predicted_prob",
               label: str = "is_win"):
    """Calibration fitted on held-out rows: isotonic (monotone step) or
    sigmoid (logistic regression on the score)."""
    if method == "isotonic":
        return fit_isotonic(holdout, prob, label, out="calibrated_prob")
    x = holdout.withColumn("_y", F.col(label).cast("double"))
    va = VectorAssembler(inputCols=[prob], outputCol="_pv")
    lr = LogisticRegression(featuresCol="_pv", labelCol="_y", probabilityCol="_cp",
                            rawPredictionCol="_cr", predictionCol="_cl")
    return fit([va, lr], x)


def calibrate(cal, df: DataFrame) -> DataFrame:
    out = cal.transform(df)
    if "_cp" in out.columns:
        out = out.withColumn("calibrated_prob", vector_to_array("_cp")[1]).drop("_pv", "_cp", "_cr", "_cl")
    return out


def fit_ranker(train: DataFrame, feature_cols: Sequence[str], relevance_col: str = "relevance",
               **params) -> PipelineModel:
    """Pointwise ranking: regress the relevance label (I7); rank inside the
    race by the score (H6)."""
    p = dict(maxIter=500, maxDepth=5, stepSize=0.05, seed=42)
    p.update(params)
    x, _ = model_frame(train, feature_cols)
    x = x.withColumn(relevance_col, F.col(relevance_col).cast("double"))
    est = GBTRegressor(labelCol=relevance_col, featuresCol="features", predictionCol="rank_score", **p)
    return fit(_stages(feature_cols, est, with_missing(train, feature_cols)), x)


def column_importances(model: PipelineModel, values: Sequence[float], feature_cols: Sequence[str]) -> list[float]:
    """Per feature column, the sum of ``values`` (by place in the assembled vector) of its
    value and its missing flag."""
    names = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    by = dict(zip(names, values, strict=True))
    return [float(by.get(f"_i_{c}", 0.0) + by.get(f"_m_{c}", 0.0)) for c in feature_cols]


def importances(spark: SparkSession, model: PipelineModel, feature_cols: Sequence[str],
                top: int = 20, weight: float = 1.0) -> DataFrame:
    """(feature, importance) of the fitted trees, top ``top`` by importance.

    Importance of a feature = its value column plus its missing flag.
    """
    last = model.stages[-1]
    imp = last.featureImportances.toArray() if hasattr(last, "featureImportances") else \
        abs(last.coefficients.toArray())
    rows = [(c, v * weight) for c, v in zip(feature_cols, column_importances(model, imp, feature_cols), strict=True)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), "feature").limit(top)


def ensemble_importances(parts: Sequence[DataFrame], weights: Sequence[float] | None = None) -> DataFrame:
    """Mean over models of importance x normalised weight."""
    w = effective_weights(weights, len(parts))
    out = None
    for p, wi in zip(parts, w):
        x = p.select("feature", (F.col("importance") * wi).alias("importance"))
        out = x if out is None else out.unionByName(x)
    return out.groupBy("feature").agg((F.sum("importance") / len(parts)).alias("importance"))


# -- I10, I11 ----------------------------------------------------------------
def classification_metrics(df: DataFrame, by: Sequence[str] = (), threshold: float = 0.5,
                           prob: str = "predicted_prob", label: str = "is_win") -> DataFrame:
    """Accuracy, precision, recall, F1; AUC and log loss only for groups
    with both classes. Long form (by..., metric, value)."""
    by = list(by)
    x = df.withColumn("predicted_win", (F.col(prob) >= threshold).cast("long")) \
          .withColumn("is_win", F.col(label).cast("long")).withColumn("predicted_prob", F.col(prob))
    base = x.groupBy(*by).agg(
        F.avg((F.col("predicted_win") == F.col("is_win")).cast("double")).alias("accuracy"), *_M.prf_cols(),
        _M.log_loss_col().alias("log_loss"),
        F.countDistinct("is_win").alias("_classes"))
    if by:
        wide = base.join(_M.auc_roc(x, by), by)
    else:
        auc = _M.auc_roc(x.withColumn("_all", F.lit(0)), ["_all"])
        wide = base.withColumn("_all", F.lit(0)).join(auc, "_all").drop("_all")
    two = F.col("_classes") == 2
    wide = wide.withColumn("auc_roc", F.when(two, F.col("auc_roc"))).withColumn(
        "log_loss", F.when(two, F.col("log_loss")))
    names = ["accuracy", "precision", "recall", "f1", "auc_roc", "log_loss"]
    stack = F.expr("stack({}, {})".format(len(names), ", ".join(f"'{n}', CAST({n} AS DOUBLE)" for n in names)))
    return wide.select(*by, stack.alias("metric", "value")).filter(F.col("value").isNotNull())


def regression_summary(df: DataFrame, by: Sequence[str] = (), col: str = "rank_score") -> DataFrame:
    """I10 for the ranker: mean and population std of the predictions."""
    return df.groupBy(*by).agg(F.avg(col).alias("pred_mean"), F.stddev_pop(col).alias("pred_std"))


def cv_summary(fold_metrics: DataFrame) -> DataFrame:
    """Mean and population std of each metric over folds."""
    return fold_metrics.groupBy("metric").agg(F.avg("value").alias("mean"),
                                              F.stddev_pop("value").alias("std"),
                                              F.count(F.lit(1)).cast("long").alias("folds"))


def cross_validate(df: DataFrame, feature_cols: Sequence[str], order: Sequence[str], n_splits: int = 5,
                   kind: str = "gbt", threshold: float = 0.5, parallelism: int = 4, **params) -> DataFrame:
    """Metrics of a fresh model per time fold, fitted on all rows before the
    fold's test block: (test_fold, metric, value, n_rows) for ``cv_summary``, the
    metrics of the training rows as ``train_...``, of the block as ``val_...``.

    Folds are fitted from ``parallelism`` threads: a tree's levels are many short jobs."""
    from concurrent.futures import ThreadPoolExecutor

    from paddock.operators.splits import time_folds
    folds = staged(time_folds(df, order, n_splits), "cv-folds")
    bounds = folds.filter(F.col("test_fold").isNotNull()).groupBy("test_fold").agg(
        F.min("position").alias("first"), F.count(F.lit(1)).alias("n")).orderBy("test_fold").collect()   # one row per fold

    def run(b) -> DataFrame:
        rows = folds.filter((F.col("position") < b["first"]) | (F.col("test_fold") == b["test_fold"])).withColumn(
            "split", F.when(F.col("position") < b["first"], "train").otherwise("val"))
        fit = rows.filter(F.col("split") == "train")
        live = [c for c, n in fit.agg(*[F.count(c).alias(c) for c in feature_cols]).first().asDict().items() if n]
        model = fit_classifier(fit, live, kind, **params)
        # the metrics read the scores several times: score once, and keep only these
        scores = staged(predict_proba(model, rows, live).select("split", "is_win", "predicted_prob"), "cv-scores")
        return scores.withColumns({"test_fold": F.lit(b["test_fold"]).cast("long"), "n_rows": F.when(
            F.col("split") == "train", b["first"]).otherwise(b["n"]).cast("long")})

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        scored = list(pool.map(run, bounds))
    if not scored:
        return df.sparkSession.createDataFrame([], "test_fold long, metric string, value double, n_rows long")
    m = classification_metrics(functools.reduce(DataFrame.unionByName, scored), by=["test_fold", "split", "n_rows"], threshold=threshold)
    return m.select("test_fold", F.concat_ws("_", "split", "metric").alias("metric"), "value", "n_rows")


def fit_calibrated(fit_rows: DataFrame, cal_rows: DataFrame, thr_rows: DataFrame, feature_cols: Sequence[str],
                   kind: str = "gbt", method: str = "sigmoid", **params):
    """(scorer, threshold): a classifier, calibrated on ``cal_rows``, and the
    best F1 threshold of the calibrated probability on ``thr_rows``."""
    model = fit_classifier(fit_rows, feature_cols, kind, **params)
    cal = calibrator(predict_proba(model, cal_rows, feature_cols), method)

    def scorer(df: DataFrame) -> DataFrame:
        out = calibrate(cal, predict_proba(model, df, feature_cols))
        return out.withColumn("predicted_prob", F.col("calibrated_prob")).drop("calibrated_prob")

    return scorer, float(_M.best_threshold(scorer(thr_rows)).first()["threshold"])


def train_step(train: DataFrame, validation: DataFrame, feature_cols: Sequence[str], order: Sequence[str],
               kind: str = "gbt", **params) -> tuple[DataFrame, float]:
    """Fit on ``train``; the first half of the validation rows calibrates,
    the second half chooses the threshold; train and validation metrics."""
    from paddock.operators.splits import temporal_split
    halves = staged(temporal_split(validation.drop("split"), order, 0.5), "validation-halves")
    first, second = (halves.filter(F.col("split") == s).drop("split") for s in ("train", "validation"))
    scorer, t = fit_calibrated(train, first, second, feature_cols, kind, **params)
    both = train.drop("split").withColumn("split", F.lit("train")).unionByName(
        validation.drop("split").withColumn("split", F.lit("validation")))
    return classification_metrics(scorer(both), by=["split"], threshold=t), t


def walk_forward(df: DataFrame, periods: DataFrame, feature_cols: Sequence[str], order: Sequence[str],
                 holdout: float = 0.2, kind: str = "gbt", date_col: str = "race_date", **params) -> DataFrame:
    """H8: scored test rows of every period, each by a model of its own.

    The first ``1 - holdout`` of a period's training rows fit, the rest
    calibrate and choose the threshold. Periods are bounded by the calendar;
    each reads its date range of ``df``, so no row is copied per period.
    """
    from paddock.operators.splits import temporal_split
    out = None
    for p in periods.orderBy("period").collect():
        rows = df.filter(F.col(date_col).cast("date").between(F.lit(p["train_start"]), F.lit(p["train_end"])))
        split = staged(temporal_split(rows, order, holdout).select(*dict.fromkeys([date_col, "is_win", "split", *feature_cols])), "period")
        fit, hold = split.filter(F.col("split") == "train"), split.filter(F.col("split") != "train")
        live = [c for c, n in fit.agg(*[F.count(c).alias(c) for c in feature_cols]).first().asDict().items() if n]
        scorer, t = fit_calibrated(fit, hold, hold, live, kind, **params)
        last = split.agg(F.max(F.col(date_col).cast("date"))).first()[0]
        test = df.filter(F.col(date_col).cast("date").between(F.lit(p["test_start"]), F.lit(p["test_end"])))
        s = scorer(test).withColumns({"period": F.lit(p["period"]), "train_max": F.lit(last),
                                      "predicted_win": (F.col("predicted_prob") >= t).cast("long")})
        out = s if out is None else out.unionByName(s)
    return out


# -- I12 ---------------------------------------------------------------------
SEARCH_SPACE = {"maxDepth": [3, 4, 5, 6, 8], "stepSize": [0.01, 0.02, 0.05, 0.1, 0.2, 0.3], "maxIter": [100, 200, 500, 1000],
                "subsamplingRate": [0.5, 0.6, 0.8, 1.0], "minInstancesPerNode": [5, 10, 20, 50, 100],
                "minInfoGain": [0.0, 1e-4, 1e-3, 1e-2], "maxBins": [32, 64, 128],
                "featureSubsetStrategy": ["all", "0.5", "0.7", "0.9"], "minWeightFractionPerNode": [0.0, 0.001, 0.01]}
LOGISTIC_SPACE = {"regParam": [0.001, 0.01, 0.1, 1.0], "elasticNetParam": [0.0, 0.5, 1.0], "maxIter": [50, 100]}
SEARCH_CANDIDATES = 50


def random_candidates(n: int = SEARCH_CANDIDATES, seed: int = 42, space: dict | None = None) -> list[dict]:
    """Seeded random search over the parameter grid (replaces a TPE sampler)."""
    rnd = random.Random(seed)
    space = space or SEARCH_SPACE
    return [{k: rnd.choice(v) for k, v in space.items()} for _ in range(n)]


@dataclass(frozen=True)
class SearchFolds:
    """What all candidates of a search share: the folds' rows, written once, each test
    block's first position and the preparation of the rows before it."""
    rows: DataFrame
    first: dict[int, int]
    prepared: dict[int, PipelineModel]


def search_folds(folds: DataFrame, feature_cols: Sequence[str]) -> SearchFolds:
    """``folds``: ``time_folds`` output (position, test_fold)."""
    rows = staged(folds, "folds")
    bounds = rows.filter(F.col("test_fold").isNotNull()).groupBy("test_fold").agg(
        F.min("position").alias("first")).collect()                 # one row per fold
    first = {int(b["test_fold"]): int(b["first"]) for b in bounds}
    return SearchFolds(rows, first, {f: fit_preparation(rows.filter(F.col("position") < p), feature_cols) for f, p in first.items()})


def param_search(df: DataFrame, feature_cols: Sequence[str], folds: DataFrame | SearchFolds | None,
                 candidates: Sequence[dict], metric: str = "auc_roc", kind: str = "gbt",
                 parallelism: int = 4) -> DataFrame:
    """Each candidate is fitted per fold (train = rows before the fold's
    test block) and scored on the block; a single-class block scores 0.5.

    ``folds``: ``time_folds`` output, or ``search_folds`` of it for several searches. Fits
    are submitted from ``parallelism`` threads (as Spark ML's own tuning does); each fit is
    a distributed Spark job. Returns one row per (candidate, fold).
    """
    from concurrent.futures import ThreadPoolExecutor

    spark = df.sparkSession
    ready = folds if isinstance(folds, SearchFolds) else search_folds(folds, feature_cols)
    rows, prepared = ready.rows, ready.prepared
    tasks = [(ci, params, f, ready.first[f]) for ci, params in enumerate(candidates) for f in sorted(ready.first)]

    def run(task) -> DataFrame:
        ci, params, f, first = task
        model = fit_classifier(rows.filter(F.col("position") < first), feature_cols, kind, prepared=prepared[f], **params)
        sc = predict_proba(model, rows.filter(F.col("test_fold") == f), feature_cols)
        # the metrics read the scores several times: score once, and keep only these
        return staged(sc.select("is_win", "predicted_prob"), "search-scores").withColumns(
            {"candidate": F.lit(ci).cast("long"), "fold": F.lit(f).cast("long")})

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        scored = list(pool.map(run, tasks))
    found = {}
    if scored:                                                      # one number per candidate and fold
        m = classification_metrics(functools.reduce(DataFrame.unionByName, scored), by=["candidate", "fold"])
        found = {(r["candidate"], r["fold"]): float(r["value"]) for r in m.filter(F.col("metric") == metric).collect()}
    scores = [(ci, json.dumps(params, sort_keys=True), f, found.get((ci, f), 0.5)) for ci, params, f, _ in tasks]
    return spark.createDataFrame(scores, "candidate long, params string, fold long, score double")


def best_params(results: DataFrame, maximize: bool = True) -> DataFrame:
    avg = results.groupBy("candidate", "params").agg(F.avg("score").alias("mean_score"))
    key = F.struct(F.col("mean_score") if maximize else -F.col("mean_score"), -F.col("candidate"))
    return avg.agg(F.max_by("params", key).alias("params"), F.max_by("mean_score", key).alias("mean_score"))


# -- I13 ---------------------------------------------------------------------
class ModelRegistry:
    """Versioned models under a shared folder plus an append-only metadata table.

    version = yyyymmdd_<8 hex>; 'latest' is the newest by created_at (plain
    string order of versions is only by day).
    """

    META_SCHEMA = ("name string, version string, model_type string, params string, metrics string, "
                   "created_at timestamp, path string")

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _meta_path(self) -> str:
        return f"{self.base}/_metadata"

    def save(self, model: PipelineModel, name: str, model_type: str, params: dict,
             metrics: dict, now: _dt.datetime | None = None, pipeline=None, feature_cols: Sequence[str] = ()) -> str:
        """Store a model, the fitted feature pipeline that feeds it and its
        feature columns under a new version."""
        now = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        h = hashlib.sha256(f"{name}|{json.dumps(params, sort_keys=True)}|{now.isoformat()}".encode()).hexdigest()[:8]
        version = f"{now:%Y%m%d}_{h}"
        path = f"{self.base}/{name}/{version}"
        model.write().overwrite().save(f"{path}/model")
        if pipeline is not None:
            pipeline.save(self.spark, f"{path}/features")
        metrics = {**metrics, "feature_cols": list(feature_cols)} if feature_cols else metrics
        row = [(name, version, model_type, json.dumps(params, sort_keys=True), json.dumps(metrics, sort_keys=True),
                now, path)]
        self.spark.createDataFrame(row, self.META_SCHEMA).write.mode("append").parquet(self._meta_path())
        return version

    def versions(self, name: str | None = None) -> DataFrame:
        m = self.spark.read.parquet(self._meta_path())
        if name is not None:
            m = m.filter(F.col("name") == name)
        return m.orderBy("name", "version")

    def latest(self) -> DataFrame:
        m = self.spark.read.parquet(self._meta_path())
        return m.groupBy("name").agg(F.max_by("version", F.struct("created_at", "version")).alias("version"))

    def _resolve(self, name: str, version: str | None) -> str:
        return version or self.latest().filter(F.col("name") == name).first()["version"]

    def load(self, name: str, version: str | None = None) -> PipelineModel:
        return PipelineModel.load(f"{self.base}/{name}/{self._resolve(name, version)}/model")

    def load_features(self, name: str, version: str | None = None):
        """(fitted feature pipeline, feature columns) stored with a version."""
        from paddock.operators.fitted import FeaturePipelineModel
        v = self._resolve(name, version)
        meta = self.versions(name).filter(F.col("version") == v).first()
        return FeaturePipelineModel.load(self.spark, f"{self.base}/{name}/{v}/features"), json.loads(meta["metrics"])["feature_cols"]
