"""Batch scoring (J1-J4): score, rank inside races, audit columns, sink."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.operators.backtest import min_rank
from paddock.operators.models import ModelRegistry, predict_proba
from paddock.sources.sinks import rebalanced


def score(model: PipelineModel, features: DataFrame, feature_cols: Sequence[str],
          ids: Sequence[str] = ("race_id", "horse_id"), threshold: float = 0.5,
          sort: bool = False) -> DataFrame:
    """Ids, ``win_probability`` and the class ``prediction``.

    ``sort`` orders by race ascending, probability descending (a range-
    partitioned sort, only for presentation of the output).
    """
    p = predict_proba(model, features, feature_cols, out="win_probability")
    out = p.select(*ids, "win_probability",
                   (F.col("win_probability") >= threshold).cast("int").alias("prediction"))
    if sort:
        out = out.orderBy(F.col(ids[0]).asc(), F.col("win_probability").desc())
    return out


def rank_scores(df: DataFrame, prob: str = "win_probability") -> DataFrame:
    """``rank`` 1 = highest probability in the race, ties share the lowest
    rank; global ranking when there is no race_id."""
    group = "race_id" if "race_id" in df.columns else None
    return min_rank(df, prob=prob, group=group)


def audit(df: DataFrame, model_name: str, model_version: str | None = None,
          predicted_at: dt.datetime | None = None) -> DataFrame:
    """Audit columns (version 'latest' when not pinned)."""
    at = predicted_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return df.withColumns({"predicted_at": F.lit(at), "model_name": F.lit(model_name),
                           "model_version": F.lit(model_version or "latest")})


def summary(df: DataFrame) -> DataFrame:
    """J3 summary: distinct races and rows scored."""
    return df.agg(F.countDistinct("race_id").cast("long").alias("n_races"),
                  F.count(F.lit(1)).cast("long").alias("n_rows"))


def batch_predict(registry: ModelRegistry, name: str, raw: DataFrame,
                  version: str | None = None, sink: str | None = None,
                  date_col: str = "race_date") -> DataFrame:
    """Load the model (pinned or latest) and the feature pipeline fitted
    with it, turn ``raw`` rows into features, score, rank, audit, append to the
    sink (the reference refits the pipeline on the scoring batch)."""
    model = registry.load(name, version)
    pipeline, feature_cols = registry.load_features(name, version)
    features = pipeline.transform(raw)
    cols = ["race_id", "horse_id"] + ([date_col] if date_col in features.columns else [])
    s = rank_scores(score(model, features, feature_cols, ids=cols))
    out = audit(s, name, version)
    if sink is not None:
        w = out.withColumn("predicted_date", F.col(date_col)) if date_col in out.columns else out
        by = ["predicted_date"] if date_col in out.columns else []
        rebalanced(w, by).write.mode("append").partitionBy(*by).parquet(sink)
    return out
