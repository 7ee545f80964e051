"""A typed run log and the comparison of runs.

Records of a run are parameters (text), metrics (number with a step) and are
kept in one append-only table, a partition per batch: writing a batch again
replaces it, so a retried job doubles nothing. The comparison pivots the typed
values into columns and can be exported as one CSV file, a report of at most
``newest`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NULL = "\\N"                     # how the CSV writes a null
RECORD = "run_id string, start_time timestamp, kind string, key string, number double, text string, step long"


def metric_records(log: DataFrame) -> DataFrame:
    """Records of a long-form metric log (run_id, start_time, key, value, step)."""
    return log.select(F.col("run_id").cast("string"), "start_time", F.lit("metric").alias("kind"), F.col("key").cast("string"),
                      F.col("value").cast("double").alias("number"), F.lit(None).cast("string").alias("text"), F.col("step").cast("long"))


def param_records(runs: DataFrame, params: Sequence[str]) -> DataFrame:
    """Records of the parameters of runs: a row per run (run_id, start_time and
    ``params`` as columns); a null parameter was not given."""
    pairs = F.array(*[F.struct(F.lit(p).alias("key"), F.col(p).cast("string").alias("text")) for p in params])
    return (runs.select(F.col("run_id").cast("string"), "start_time", F.explode(pairs).alias("p")).filter("p.text is not null")
                .select("run_id", "start_time", F.lit("param").alias("kind"), "p.key", F.lit(None).cast("double").alias("number"),
                        "p.text", F.lit(0).cast("long").alias("step")))


def append_records(records: DataFrame, path: str, batch: str) -> None:
    """Write a batch of records; the same batch again takes the place of the first."""
    (records.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch").parquet(path))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{RECORD}, batch string").parquet(path)


def compare_runs(records: DataFrame, metrics: Sequence[str], params: Sequence[str] = (), newest: int = 5,
                 sort_metric: str | None = None) -> DataFrame:
    """The newest runs: run_id, start_time, ``param_<name>`` and ``<metric>``
    columns, each the last value logged (by step). One aggregate gives all
    columns; the cut and the order are over runs."""
    last = lambda kind, key, value: F.max_by(
        F.when((F.col("kind") == kind) & (F.col("key") == key), F.col(value)),
        F.when((F.col("kind") == kind) & (F.col("key") == key) & F.col(value).isNotNull(), F.col("step")))
    runs = records.groupBy("run_id").agg(
        F.min("start_time").alias("start_time"), *[last("param", p, "text").alias(f"param_{p}") for p in params],
        *[last("metric", m, "number").alias(m) for m in metrics])
    top = runs.orderBy(F.col("start_time").desc(), F.col("run_id").desc()).limit(newest)
    return top.orderBy(F.col(sort_metric).desc_nulls_last(), "run_id") if sort_metric in metrics else top


def export_csv(comparison: DataFrame, path: str) -> None:
    """One CSV file with a header; a null is ``NULL``, an empty text two quotes."""
    (comparison.coalesce(1).write.mode("overwrite").option("header", True).option("emptyValue", '""').option("escape", '"').option("nullValue", NULL)
               .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path))


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return (spark.read.schema(schema).option("header", True).option("emptyValue", "").option("nullValue", NULL).option("escape", '"').option("multiLine", True)
                 .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path))
