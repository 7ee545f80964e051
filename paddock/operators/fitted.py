"""Encoders and scalers fitted on training rows and applied anywhere.

Scalers and wide one-hot encoders keep their fitted state as model parameters (four
numbers per scaled column; the values of a one-hot column are its output
columns) and apply it as a projection. The mapping of a label or sparse one-hot
encoder is a frame of (value, code) per column, however many categories there are:
codes are positions in the distributed order of the distinct values, found by ``fit``,
and applying it is a left join that the optimizer plans by size.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.functions.features import extract, feature_columns
from paddock.session import shuffle_parts, staged

# -- G1, G2 ------------------------------------------------------------------
_MAPPED = ("label", "sparse")


def _one_at(code: Column, size: int) -> Column:
    """A sparse vector's fields: one 1.0 at ``code``, none where it is null."""
    at = code.cast("int")
    some = at.isNotNull()
    return F.struct(F.lit(size).alias("size"), F.when(some, F.array(at)).otherwise(F.array().cast("array<int>")).alias("indices"),
                    F.when(some, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("values"))


def as_vector(sparse: str | Column) -> Column:
    """Spark ML vector of a sparse one-hot column, for an assembler or a model.

    Every category is one entry of the vector, so nothing is expanded, and no
    list of category names is kept with the column.
    """
    s = F.col(sparse) if isinstance(sparse, str) else sparse
    fields = F.struct(F.struct(F.lit(0).cast("byte").alias("type"), s["size"].alias("size"), s["indices"].alias("indices"),
                               s["values"].alias("values")).alias("v"))
    vector = F.from_json(F.to_json(fields), T.StructType([T.StructField("v", VectorUDT())]))["v"]
    return F.when(s.isNotNull(), vector)


@dataclass
class CategoryEncoderModel:
    """``mappings``: column -> frame (value, code) for labels and sparse one-hot,
    or the list of values of a one-hot column. ``sizes``: column -> number of
    values, for sparse one-hot."""
    mappings: dict
    strategy: str = "label"
    sizes: dict = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        cols: dict[str, Column] = {}
        for i, (c, values) in enumerate(self.mappings.items()):
            if c not in df.columns:
                continue
            if self.strategy in _MAPPED:
                m = values.select(F.col("value").alias(f"_v{i}"), F.col("code").alias(f"_c{i}"))
                out = out.join(m, F.col(c).cast("string") == F.col(f"_v{i}"), "left")
                if self.strategy == "label":
                    out = out.withColumn(f"{c}_encoded", F.coalesce(f"_c{i}", F.lit(-1)).cast("long"))
                else:
                    out = out.withColumn(f"{c}_onehot", F.when(F.col(c).isNotNull(), _one_at(F.col(f"_c{i}"), self.sizes[c])))
                out = out.drop(f"_v{i}", f"_c{i}")
            else:
                s = F.col(c).cast("string")
                cols |= {f"{c}_{v}": (s == F.lit(v)).cast("long") for v in values}
        return out.withColumns(cols) if cols else out

    def save(self, path: str) -> dict:
        """Write label mappings below ``path``; returns the rest as plain data."""
        if self.strategy in _MAPPED:
            for c, m in self.mappings.items():
                m.write.mode("overwrite").parquet(f"{path}/{c}")
            return {"strategy": self.strategy, "columns": list(self.mappings), "sizes": self.sizes}
        return {"strategy": self.strategy, "mappings": self.mappings}

    @classmethod
    def load(cls, spark: SparkSession, d: dict, path: str) -> CategoryEncoderModel:
        if d["strategy"] in _MAPPED:
            return cls({c: spark.read.parquet(f"{path}/{c}") for c in d["columns"]}, d["strategy"], d.get("sizes", {}))
        return cls(d["mappings"], d["strategy"])


def _codes(df: DataFrame, cols: Sequence[str]) -> dict[str, DataFrame]:
    """column -> frame (value, code): the place of each distinct value in the
    order of the column's own type.

    The distinct values of all columns are found in one pass, dealt to sampled
    ranges and written; a code is the place in the range plus the values of the
    column in earlier ranges (one number per range and column).
    """
    if not cols:
        return {}

    def keys(c: str) -> Column:
        kind = df.schema[c].dataType
        whole = isinstance(kind, T.IntegralType | T.DecimalType | T.BooleanType)
        part = isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType)
        at = F.col(c).cast("int") if isinstance(kind, T.BooleanType) else F.col(c)
        return F.struct(F.lit(cols.index(c)).alias("c"), (at if whole else F.lit(None)).cast("decimal(38,9)").alias("whole"),
                        (at if part else F.lit(None)).cast("double").alias("part"), F.col(c).cast("string").alias("value"))

    order = ["c", "whole", "part", "value"]
    found = df.select(F.explode(F.array(*[keys(c) for c in cols])).alias("k")).select("k.*").filter("value is not null").distinct()
    ranged = staged(found.repartitionByRange(shuffle_parts(df.sparkSession), *order).withColumn("piece", F.spark_partition_id()), "label-values")
    offsets, seen = [], {}
    for r in ranged.groupBy("c", "piece").count().orderBy("c", "piece").collect():
        offsets += [F.lit(f"{r['c']}:{r['piece']}"), F.lit(seen.get(r["c"], 0))]
        seen[r["c"]] = seen.get(r["c"], 0) + r["count"]
    before = F.element_at(F.create_map(*offsets), F.concat_ws(":", "c", "piece")) if offsets else F.lit(0)
    place = F.row_number().over(Window.partitionBy("c", "piece").orderBy(*order)) - 1
    codes = staged(ranged.select("c", "value", (place + before).cast("long").alias("code")), "label-codes")
    return {c: codes.filter(F.col("c") == i).select("value", "code") for i, c in enumerate(cols)}


@dataclass
class CategoryEncoder:
    """Label (sorted distinct non-null values -> 0..k-1, unseen/null -> -1) or
    one-hot (``{c}_{value}`` 0/1 per fitted value; null stays null).

    "sparse" is one-hot for columns of very many values: one column ``{c}_onehot``
    of (size, indices, values), null for null, without an index for unseen values.
    Its width does not grow with the categories and no value reaches the driver.
    """
    columns: Sequence[str]
    strategy: str = "label"

    def fit(self, df: DataFrame) -> CategoryEncoderModel:
        cols = [c for c in self.columns if c in df.columns]
        if self.strategy == "label":
            return CategoryEncoderModel(_codes(df, cols), "label")
        if self.strategy == "sparse":
            codes = _codes(df, cols)
            return CategoryEncoderModel(codes, "sparse", {c: m.count() for c, m in codes.items()})
        if not cols:
            return CategoryEncoderModel({}, self.strategy)
        row = df.agg(*[F.array_sort(F.collect_set(F.col(c))).alias(c) for c in cols]).first()
        return CategoryEncoderModel({c: [str(v) for v in (row[c] or [])] for c in cols}, self.strategy)


# -- G3, G4 ------------------------------------------------------------------
@dataclass
class ColumnStats:
    mean: float
    std: float
    min: float
    max: float


@dataclass
class ScalerModel:
    stats: dict[str, ColumnStats]
    strategy: str = "standard"

    def transform(self, df: DataFrame) -> DataFrame:
        cols = {}
        for c, s in self.stats.items():
            if c not in df.columns:
                continue
            x = F.col(c).cast("double")
            if self.strategy == "standard":
                cols[f"{c}_scaled"] = (x - F.lit(s.mean)) / F.lit(s.std)
            else:
                cols[f"{c}_scaled"] = (x - F.lit(s.min)) / F.lit(s.max - s.min)
        return df.withColumns(cols) if cols else df

    def to_json(self) -> str:
        return json.dumps({"strategy": self.strategy,
                           "stats": {c: vars(s) for c, s in self.stats.items()}})

    @classmethod
    def from_json(cls, s: str) -> ScalerModel:
        d = json.loads(s)
        return cls({c: ColumnStats(**v) for c, v in d["stats"].items()}, d["strategy"])


@dataclass
class FeatureScaler:
    """Standard (sample std, ddof 1) or min-max scaling, ``{c}_scaled``.

    Guards: null mean -> 0, null or zero std -> 1, null min -> 0, null max -> 1,
    max == min -> max = min + 1. (The reference also turns a max of exactly 0
    into 1; here only a missing max defaults.)
    """
    columns: Sequence[str]
    strategy: str = "standard"

    def fit(self, df: DataFrame) -> ScalerModel:
        cols = [c for c in self.columns if c in df.columns]
        if not cols:
            return ScalerModel({}, self.strategy)
        aggs = []
        for i, c in enumerate(cols):
            x = F.col(c).cast("double")
            aggs += [F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                     F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
        r = df.agg(*aggs).first()
        stats = {}
        for i, c in enumerate(cols):
            mean = r[f"m{i}"] if r[f"m{i}"] is not None else 0.0
            std = r[f"s{i}"] if r[f"s{i}"] not in (None, 0.0) and r[f"s{i}"] == r[f"s{i}"] else 1.0
            lo = r[f"lo{i}"] if r[f"lo{i}"] is not None else 0.0
            hi = r[f"hi{i}"] if r[f"hi{i}"] is not None else 1.0
            if hi == lo:
                hi = lo + 1.0
            stats[c] = ColumnStats(mean, std, lo, hi)
        return ScalerModel(stats, self.strategy)


# -- G5 ----------------------------------------------------------------------
@dataclass
class FeaturePipelineModel:
    extractors: Sequence[str]
    encoder: CategoryEncoderModel | None = None
    scaler: ScalerModel | None = None
    options: dict = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        out = extract(df, self.extractors, **self.options)
        if self.encoder is not None:
            out = self.encoder.transform(out)
        if self.scaler is not None:
            out = self.scaler.transform(out)
        return out

    def save(self, spark: SparkSession, path: str) -> None:
        """Persist the fitted state next to the model (one small JSON row, and
        the label mappings as tables)."""
        dates = {k: v.isoformat() for k, v in self.options.items() if isinstance(v, dt.date)}
        row = {"extractors": list(self.extractors),
               "encoder": self.encoder.save(f"{path}/labels") if self.encoder else None,
               "scaler": self.scaler.to_json() if self.scaler else None,
               "options": {k: v for k, v in self.options.items() if k not in dates}, "dates": dates}
        spark.createDataFrame([(json.dumps(row, ensure_ascii=False),)], "state string") \
             .coalesce(1).write.mode("overwrite").json(f"{path}/state")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FeaturePipelineModel:
        d = json.loads(spark.read.schema("state string").json(f"{path}/state").first()["state"])
        return cls(d["extractors"],
                   CategoryEncoderModel.load(spark, d["encoder"], f"{path}/labels") if d["encoder"] else None,
                   ScalerModel.from_json(d["scaler"]) if d["scaler"] else None,
                   d["options"] | {k: dt.date.fromisoformat(v) for k, v in d["dates"].items()})


@dataclass
class FeaturePipeline:
    """Extract -> fit encoder -> encode -> fit scaler, all on training rows."""
    extractors: Sequence[str] = ("race", "horse", "jockey", "running_style")
    encoder: CategoryEncoder | None = None
    scaler: FeatureScaler | None = None
    options: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> FeaturePipelineModel:
        x = extract(df, self.extractors, **self.options)
        enc = self.encoder.fit(x) if self.encoder else None
        if enc is not None:
            x = enc.transform(x)
        sc = self.scaler.fit(x) if self.scaler else None
        return FeaturePipelineModel(self.extractors, enc, sc, dict(self.options))

    def transform(self, df: DataFrame) -> DataFrame:
        """Only stateless pipelines can transform without fitting."""
        if self.encoder is not None or self.scaler is not None:
            raise RuntimeError("a pipeline with an encoder or a scaler has state: call fit first")
        return extract(df, self.extractors, **self.options)


__all__ = ["CategoryEncoder", "CategoryEncoderModel", "FeatureScaler", "ScalerModel",
           "FeaturePipeline", "FeaturePipelineModel", "feature_columns"]
