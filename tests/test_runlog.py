"""The typed run log: batches, types, comparison and the CSV."""

import datetime as dt

from paddock.operators import runlog as RL

T0 = dt.datetime(2024, 1, 1, 12, 0, 0, 123456)


def _runs(spark):
    log = spark.createDataFrame([(r, T0 + dt.timedelta(days=r), k, v, s) for r in range(4)
                                 for k, v, s in (("auc", 0.5 + r / 10, 0), ("auc", 0.6 + r / 10, 1), ("auc", None, 2), ("loss", 1.0 * r, 0))],
                                "run_id long, start_time timestamp, key string, value double, step long")
    params = spark.createDataFrame([(r, T0 + dt.timedelta(days=r), "gbt" if r else None, 0.1 * r, 'a "quoted", text\nwith lines' if r == 2 else "") for r in range(4)],
                                   "run_id long, start_time timestamp, model string, rate double, note string")
    return RL.metric_records(log), RL.param_records(params, ["model", "rate", "note"])


def test_batches_are_idempotent(spark, tmp_path):
    metrics, params = _runs(spark)
    path = str(tmp_path / "log")
    for batch, records in (("m", metrics), ("p", params), ("p", params)):
        RL.append_records(records, path, batch)
    back = RL.read_records(spark, path)
    assert back.count() == 16 + 11 and {r[0] for r in back.select("batch").distinct().collect()} == {"m", "p"}
    got = back.filter("kind = 'param' and run_id = '2'").select("key", "text").collect()
    assert {tuple(r) for r in got} == {("model", "gbt"), ("rate", "0.2"), ("note", 'a "quoted", text\nwith lines')}


def test_comparison_and_csv(spark, tmp_path):
    metrics, params = _runs(spark)
    c = RL.compare_runs(metrics.unionByName(params), ["auc", "loss"], ["model", "note"], newest=3, sort_metric="loss")
    assert c.columns == ["run_id", "start_time", "param_model", "param_note", "auc", "loss"]
    rows = [tuple(r) for r in c.collect()]
    assert [(r[0], r[2], round(r[4], 6), r[5]) for r in rows] == [("3", "gbt", 0.9, 3.0), ("2", "gbt", 0.8, 2.0), ("1", "gbt", 0.7, 1.0)]
    path = str(tmp_path / "csv")
    RL.export_csv(c, path)
    assert len(list((tmp_path / "csv").glob("*.csv"))) == 1
    back = RL.read_csv(spark, path, c._jdf.schema().toDDL())
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)


def test_empty(spark, tmp_path):
    metrics, params = _runs(spark)
    assert RL.compare_runs(metrics.limit(0), ["auc"], ["model"]).count() == 0
