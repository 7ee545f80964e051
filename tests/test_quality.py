"""Quality checks: counts from footers, violations and messages of a view."""

import contextlib
import io

from pyspark.sql import functions as F

from paddock.operators import ingest as I
from paddock.operators.quality import summary, validate
from paddock.sources.tables import counted

SCHEMA = "a long, b string, c double, d date"


def _plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_flat_tables_are_counted_from_footers(spark, tmp_path):
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    df = spark.range(1000).select(F.col("id").alias("a"), F.when(F.col("id") % 4 == 0, F.lit("x")).alias("b"),
                                  F.when(F.col("id") % 10 > 0, F.col("id") / 2).alias("c"), F.lit(None).cast("date").alias("d"))
    path = str(tmp_path / "flat")
    df.repartition(3).write.parquet(path)
    used = spark.conf.get("spark.sql.sources.useV1SourceList")
    x = counted(spark, path, df.schema)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == used
    checks = validate(x, "t", ["a", "e"], 0.5)
    assert "PushedAggregation: [COUNT(*)" in _plan(checks) and "Filter" not in _plan(x)
    assert sorted(map(tuple, checks.collect())) == sorted(map(tuple, validate(df, "t", ["a", "e"], 0.5).collect()))
    assert {(r["column"], r["error_type"], r["value"]) for r in checks.collect()} == {
        ("e", "missing_column", None), ("b", "high_null_rate", 0.75), ("d", "high_null_rate", 1.0)}


def test_nested_tables_are_counted_by_rows(spark, tmp_path):
    df = spark.range(20).select(F.when(F.col("id") < 5, F.array(F.lit(None).cast("long"), F.lit(1).cast("long"))).alias("v"), "id")
    path = str(tmp_path / "nested")
    df.write.parquet(path)
    got = validate(counted(spark, path, df.schema), "n", ["v"], 0.5).collect()
    assert [(r["column"], r["value"]) for r in got] == [("v", 0.75)]


def test_empty_frame_and_odd_names(spark):
    df = spark.createDataFrame([], "`it's` long, `a b` string")
    got = summary(df, "d'q", ["it's", "m'c"], 0.1).first()
    assert got["dataset"] == "d'q" and got["rows"] == 0
    assert [(v["column"], v["error_type"], v["message"]) for v in got["violations"]] == [
        ("m'c", "missing_column", "Required column 'm'c' is missing"), ("*", "empty_dataframe", "DataFrame has no rows")]


def test_import_messages_name_the_view(spark):
    races = spark.createDataFrame([(1, None), (2, None)], "race_id long, course string")
    horses = spark.createDataFrame([(1, 5)], "race_id long, horse_id long")
    rows = I.import_messages(races, horses, horses).filter("error_type <> 'missing_column'").collect()
    assert [tuple(r) for r in rows] == [("races", "course", "high_null_rate", 1.0, "Column 'course' has 100.0% nulls (threshold: 50.0%)")]
    s = {r["view"]: (r["rows"], r["violations"]) for r in I.import_summary(races, horses, horses).collect()}
    assert s["races"] == (2, 9) and s["horse_results"] == (1, len(I.HORSE_RESULT_COLUMNS) - 2)
