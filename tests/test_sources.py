"""Write dispositions, year import, feature extractor registry, global ranks."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paddock.functions.features import extract
from paddock.operators.backtest import min_rank
from paddock.session import scratch_dir
from paddock.sources import sinks as K


def test_write_dispositions(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "race_id long, v string")
    path = scratch_dir(spark, "t")
    assert not K.table_exists(spark, path)
    assert K.write_table(df, path, "EMPTY")                 # missing table: allowed
    with pytest.raises(ValueError):
        K.write_table(df, path, "EMPTY")                    # filled table: refused
    K.write_table(df, path, "APPEND")
    assert spark.read.parquet(path).count() == 4
    K.write_table(df.limit(1), path, "TRUNCATE")
    assert spark.read.parquet(path).count() == 1
    assert not K.write_table(df.limit(0), path, "TRUNCATE")  # empty frame skipped
    assert spark.read.parquet(path).count() == 1


def test_year_import_replaces_only_reimported_years(spark):
    rows = [(1, dt.date(2020, 5, 1)), (2, dt.date(2021, 5, 1)), (3, None)]
    df = spark.createDataFrame(rows, "race_id long, race_date date")
    path = scratch_dir(spark, "y")
    K.import_by_year(df, path)
    K.import_by_year(df.filter(F.col("race_id") == 2), path)
    back = {r["race_id"] for r in spark.read.parquet(path).collect()}
    assert back == {1, 2, 3}                                # null date kept, 2020 untouched


def test_unknown_extractor_raises(spark):
    with pytest.raises(ValueError):
        extract(spark.createDataFrame([(1,)], "distance int"), ["race", "pace"])


def test_global_min_rank(spark):
    df = spark.createDataFrame([("h1", 0.9), ("h2", 0.5), ("h3", 0.9), ("h4", 0.1)],
                               "horse_id string, win_probability double")
    r = {x["horse_id"]: x["rank"] for x in min_rank(df, group=None).collect()}
    assert r == {"h1": 1, "h3": 1, "h2": 3, "h4": 4}


def test_year_import_runs_its_input_once(spark, tmp_path):
    path, runs = str(tmp_path / "years"), spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    rows = [(i, f"{1990 + i % 4}-05-01" if i % 5 else None) for i in range(40)]
    df = (spark.createDataFrame(rows, "id int, d string").mapInArrow(seen, "id int, d string")
          .select("id", F.to_date("d").alias("race_date")))
    want = Counter(int(d[:4]) if d else None for _, d in rows)
    assert {r["year"]: r["rows"] for r in K.import_by_year(df, path).collect()} == want
    assert runs.value == 40
    one = df.filter(F.year("race_date") == 1991).limit(2)
    assert [tuple(r) for r in K.import_by_year(one, path).collect()] == [(1991, 2)]
    assert K.import_by_year(df.limit(0), path).count() == 0
    left = {r["year"]: r["count"] for r in spark.read.parquet(path).groupBy("year").count().collect()}
    assert left == {**want, 1991: 2}
