"""Sinks: partitioned parquet, write dispositions, year import, feature store,
prediction sink (A10-A17).

Tables are parquet folders (a catalog table name works too where noted).
Every write is one partitioned write; there are no per-date or per-year loops.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def rebalanced(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Group rows by the partition columns before a partitioned write.

    Without it every task writes a file into every partition folder. The
    ``rebalance`` hint lets AQE split a hot partition value over several
    tasks and merge small ones, so file sizes stay even.
    """
    return df.hint("rebalance", *cols) if cols else df


def table_exists(spark: SparkSession, name_or_path: str) -> bool:
    """A catalog table or a readable parquet folder."""
    if "/" not in name_or_path:
        return spark.catalog.tableExists(name_or_path)
    try:
        spark.read.parquet(name_or_path).schema
        return True
    except AnalysisException:
        return False


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str] = ("race_date",),
                      mode: str = "append") -> bool:
    """One partitioned write; an empty frame writes nothing.

    Returns whether anything was written.
    """
    if df.isEmpty():
        return False
    rebalanced(df, partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)
    return True


def write_table(df: DataFrame, path: str, disposition: str = "APPEND",
                partition_by: Sequence[str] = ()) -> bool:
    """APPEND, TRUNCATE (replace all) or EMPTY (only into a missing or
    empty table, else error). An empty frame is skipped."""
    spark = df.sparkSession
    if df.isEmpty():
        return False
    d = disposition.upper()
    if d == "EMPTY":
        if table_exists(spark, path) and not spark.read.parquet(path).isEmpty():
            raise ValueError(f"table {path} is not empty (WRITE_EMPTY)")
        mode = "overwrite"
    elif d == "TRUNCATE":
        mode = "overwrite"
    elif d == "APPEND":
        mode = "append"
    else:
        raise ValueError(f"unknown disposition {disposition}")
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if mode == "overwrite" and partition_by:
        # replace the whole table, not only the partitions present in df
        w = w.option("partitionOverwriteMode", "static")
    w.parquet(path)
    return True


def import_by_year(df: DataFrame, path: str, date_col: str = "race_date") -> DataFrame:
    """One write partitioned by year with dynamic partition overwrite.

    Re-importing a range replaces only the years it contains (the reference
    truncates the whole table on its first year). Rows with a null date land
    in the null-year partition instead of being dropped. Returns (year, rows)
    of what was written.

    The input runs once: the write itself observes which years it contains (one bit
    a year), and since it replaces those partitions whole, their rows are counted in
    the written files, of which no data column is read.
    """
    x = df.withColumn("year", F.year(date_col))
    seen = Observation()
    w = rebalanced(x.observe(seen, F.bitmap_construct_agg(F.col("year").cast("long")).alias("years"),
                             F.count_if(F.col("year").isNull()).alias("undated")), ["year"])
    w.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)
    got = seen.get
    years = [8 * i + j for i, byte in enumerate(got["years"] or b"") for j in range(8) if byte >> j & 1]
    written = F.col("year").isin(years)
    if got["undated"]:
        written = written | F.col("year").isNull()
    return (df.sparkSession.read.schema(x.schema).parquet(path).filter(written)
              .groupBy("year").agg(F.count(F.lit(1)).cast("long").alias("rows")))


def save_features(df: DataFrame, path: str, mode: str = "append") -> bool:
    """Feature table partitioned by race date (append or truncate)."""
    m = "overwrite" if mode in ("truncate", "overwrite") else "append"
    if df.isEmpty():
        return False
    w = rebalanced(df, ["race_date"]).write.mode(m).partitionBy("race_date")
    if m == "overwrite":
        w = w.option("partitionOverwriteMode", "static")
    w.parquet(path)
    return True


def load_features(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                  race_ids: DataFrame | Sequence | None = None) -> DataFrame:
    """Optional column list and race-id restriction.

    A short literal list becomes an ``IN`` filter (pushed to the scan); a
    DataFrame of ids is a semi join (broadcast when the optimizer sees it is
    small, otherwise a shuffle join).
    """
    df = spark.read.parquet(path)
    if race_ids is not None:
        if isinstance(race_ids, DataFrame):
            df = df.join(race_ids.select("race_id").distinct(), "race_id", "left_semi")
        else:
            df = df.filter(F.col("race_id").isin(list(race_ids)))
    if columns:
        df = df.select(*columns)
    return df


def save_feature_table(df: DataFrame, name: str, path: str | None = None, key: str = "race_id", buckets: int = 200,
                       mode: str = "append") -> bool:
    """A14, clustered: a catalog table bucketed and sorted by ``key``.

    The one shuffle on the write is the last one on that key: loading a set of keys
    reads their buckets only, and joins or aggregates on the key of tables with as
    many buckets need no exchange. ``path``: shared folder of the files (by default
    the warehouse). Appends must keep the table's buckets. An empty frame writes nothing.
    """
    if df.isEmpty():
        return False
    m = "overwrite" if mode in ("truncate", "overwrite") else "append"
    w = df.repartition(buckets, key).write.mode(m).format("parquet").bucketBy(buckets, key).sortBy(key)
    (w.option("path", path) if path else w).saveAsTable(name)
    return True


def load_feature_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None,
                       keys: DataFrame | Sequence | None = None, key: str = "race_id") -> DataFrame:
    """A15 on a clustered table: optional column list and restriction to ``keys``
    (literals prune buckets; a frame of keys is a semi join in place)."""
    df = spark.table(name)
    if isinstance(keys, DataFrame):
        df = df.join(keys.select(key), key, "left_semi")
    elif keys is not None:
        df = df.filter(F.col(key).isin(list(keys)))
    return df.select(*columns) if columns else df


def sink_predictions(df: DataFrame, table_path: str, json_path: str | None = None,
                     date_col: str = "predicted_date") -> None:
    """Append to the predictions table; optional JSON dump by date."""
    df.write.mode("append").parquet(table_path)
    if json_path is not None:
        rebalanced(df, [date_col]).write.mode("append").partitionBy(date_col).json(json_path)
