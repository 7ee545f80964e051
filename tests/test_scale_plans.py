"""What keeps the large jobs within disk, memory and time: narrow shuffles, bounded fit
tasks, shared preparation, shuffle partitions that follow the rows."""

import datetime as dt
import uuid

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from paddock import session as SE
from paddock.functions import parsers as P
from paddock.operators import models as ML
from paddock.operators import parzen as PZ
from paddock.operators import sequence
from paddock.operators.sequence import rolling
from paddock.operators.splits import time_folds
from paddock.plans import q_models as QM
from paddock.plans import q_sources as QS
from paddock.plans.bindings import entries, runners
from paddock.plans.catalog import QUERIES, load_all
from paddock.plans.q_history import training
from paddock.sources import landing as L


def _plan(df) -> str:
    key = "spark.sql.debug.maxToStringFields"
    df.sparkSession.conf.set(key, "1000")
    try:
        return df._jdf.queryExecution().optimizedPlan().treeString()
    finally:
        df.sparkSession.conf.unset(key)


def test_history_windows_hold_no_made_columns(spark, sf_small):
    """The domain columns are made after the last shuffle, above every window."""
    plan = _plan(training(spark, sf_small))
    top = plan.index("Window")
    for made in ("track_type", "weather", "track_condition", "sex", "win_odds", "bet_amount"):
        assert f"AS {made}#" in plan[:top] and f"{made}#" not in plan[top:]


def test_the_split_reads_histories_written_once(spark, sf_small):
    """neither side of the cut computes the histories again."""
    plan = _plan(QM._split_frame(spark, sf_small))
    assert "l_partkey" not in plan and "avg_finish" in plan


def test_fits_read_staged_files_in_bounded_pieces(spark, tmp_path, monkeypatch):
    """The size of a fit's tasks does not follow the size of the files."""
    monkeypatch.setattr(SE, "FIT_SPLIT", 1 << 16)
    x = SE.staged(spark.range(200000).select(F.rand(1).alias("x"), F.rand(2).alias("y"), (F.col("id") % 2).alias("is_win"))
                       .coalesce(1), f"wide-{uuid.uuid4().hex[:6]}")
    before = spark.conf.get(SE._SPLITS)
    wide = x.select("x").rdd.getNumPartitions()
    with SE.small_splits(spark):
        with SE.small_splits(spark):
            pass
        assert spark.read.parquet(x.inputFiles()[0]).rdd.getNumPartitions() > 4 * wide
    assert spark.conf.get(SE._SPLITS) == before
    seen = []
    monkeypatch.setattr(ML, "Pipeline", lambda stages: type("P", (), {"fit": lambda self, d: seen.append(spark.conf.get(SE._SPLITS))})())
    ML.fit_classifier(x, ["x", "y"], "logistic")
    assert seen == [str(1 << 16)] and spark.conf.get(SE._SPLITS) == before


def test_candidates_share_a_folds_preparation(spark, monkeypatch):
    """one imputer fit a fold, not one a candidate and fold."""
    df = spark.range(90).select((F.col("id") % 2).alias("is_win"), F.rand(3).alias("a"), F.col("id").alias("position"),
                                F.when(F.col("id") >= 60, 1).when(F.col("id") >= 30, 0).cast("long").alias("test_fold"))
    fits, real = [], ML.Imputer

    class Counted(real):
        def _fit(self, dataset):
            fits.append(1)
            return super()._fit(dataset)

    monkeypatch.setattr(ML, "Imputer", Counted)
    found = ML.param_search(df, ["a"], df, [{"regParam": r} for r in (0.01, 0.1, 1.0)], kind="logistic")
    assert found.count() == 6 and len(fits) == 2


def test_shuffles_start_with_partitions_to_merge(spark, sf_small):
    """A task's share of a shuffle follows its bytes, not the number of cores."""
    load_all()
    QUERIES["jockey_summary"](spark, sf_small).collect()
    assert int(spark.conf.get(SE._INITIAL)) >= SE.INITIAL_PARTITIONS
    spark.conf.set(SE._INITIAL, "7")                    # a cluster's own choice stays
    try:
        assert SE.grow_partitions(spark).conf.get(SE._INITIAL) == "7"
    finally:
        spark.conf.unset(SE._INITIAL)


def test_a_fits_task_is_bounded_in_rows(spark, monkeypatch):
    """Rows that encode to almost nothing do not gather in one task."""
    monkeypatch.setattr(SE, "FIT_ROWS", 1000)
    x = SE.staged(spark.range(10000).select(F.lit(1.0).alias("x")).coalesce(1), f"rows-{uuid.uuid4().hex[:6]}")
    before = spark.conf.get(SE._OPEN)
    with SE.small_splits(spark):
        sizes = spark.read.parquet(*x.inputFiles()).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(sizes) == 10000 and max(sizes) <= 1000
    assert spark.conf.get(SE._OPEN) == before


def test_shuffle_partitions_are_merged_to_a_few_bytes(spark, sf_small):
    """a task of a sort-merge join holds what 16 MB of shuffled rows unpack to; a cluster's own size stays."""
    spark.conf.unset(SE._MERGED)
    assert SE.grow_partitions(spark).conf.get(SE._MERGED) == str(SE.MERGED_BYTES)
    spark.conf.set(SE._MERGED, "7m")
    try:
        assert SE.grow_partitions(spark).conf.get(SE._MERGED) == "7m"
    finally:
        spark.conf.unset(SE._MERGED)


def test_wide_projections_run_in_compiled_methods(spark):
    """No fused operator code longer than what the JVM compiles."""
    spark.conf.unset(SE._METHOD)
    assert int(SE.compiled_methods(spark).conf.get(SE._METHOD)) == 8000
    df = spark.createDataFrame([("1-2",), ("3-x- 4-5-6",), ("",), (None,), ("-7",)], "c string")
    corners = df.select(*[c.alias(f"c{i}") for i, c in enumerate(P.parse_corners("c"))])
    assert "split(" not in _plan(corners)                            # no pattern, no list of parts a column
    assert [tuple(r) for r in corners.collect()] == [(1, 2, None, None), (3, None, 4, 5), (None,) * 4, (None,) * 4, (None, 7, None, None)]


def test_folds_are_scored_once(spark):
    """F1: the metrics of all folds read written scores and equal each fold's own."""
    df = spark.range(240).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 4).cast("int")).alias("race_date"), "id",
                                 (F.pmod(F.xxhash64("id"), F.lit(3)) == 0).cast("long").alias("is_win"),
                                 F.pmod(F.xxhash64("id"), F.lit(7)).alias("a"))
    got = ML.cross_validate(df, ["a"], ["race_date", "id"], 3, "logistic")
    assert "UDF" not in _plan(got)
    rows = {(r["test_fold"], r["metric"]): (r["value"], r["n_rows"]) for r in got.collect()}
    for f in range(3):
        at = 60 * (f + 1)
        model = ML.fit_classifier(df.filter(F.col("id") < at), ["a"], "logistic")
        for split, part in (("train", df.filter(F.col("id") < at)), ("val", df.filter(F.col("id").between(at, at + 59)))):
            for m in ML.classification_metrics(ML.predict_proba(model, part, ["a"])).collect():
                value, n = rows.pop((f, f"{split}_{m['metric']}"))
                assert abs(value - m["value"]) < 1e-9 and n == part.count()
    assert not rows


def _landed(monkeypatch, write):
    seen = []
    with monkeypatch.context() as m:
        m.setattr(DataFrameWriter, "json", lambda self, path: seen.append(self._df))
        write()
    return _plan(seen[0])


def test_landed_races_read_their_entries_once(spark, sf_small, monkeypatch):
    """a race's own columns come with its entries, not from a second read of them."""
    plan = _landed(monkeypatch, lambda: L.land_races(entries(spark, sf_small), "unused"))
    assert plan.count("Relation [") == 2


def test_landed_races_keep_every_chunk_and_winner(spark, tmp_path):
    own = ["race_id long, race_date date, finish_position int, horse_id long, jockey_id long, odds double, weight double, course string, "
           "distance int, track_type string, track_condition string, weather string, grade string"][0]
    rows = [(r, None, p, 10 * p, p, 2.0, 50.0, f"c{p}", 1000, "t", "k", "w", None) for r, n in ((1, 5), (2, 1), (None, 2)) for p in range(1, n + 1)]
    rows += [(3, None, 2, 1, 1, 2.0, 50.0, "none", 1000, "t", "k", "w", None)]              # no winner: no record
    L.land_races(spark.createDataFrame(rows, own), str(tmp_path / "r"), chunk=2)
    got = spark.read.schema(L.RACE_SCHEMA).json(str(tmp_path / "r")).orderBy("race_id", "chunk").collect()
    assert [(r["race_id"], r["chunk"], r["course"], sorted(e["finish_position"] for e in r["entries"])) for r in got] == [
        ("1", 0, "c1", [1, 2]), ("1", 1, "c1", [3, 4]), ("1", 2, "c1", [5]), ("2", 0, "c1", [1])]


def test_pages_become_text_after_their_shuffles(spark, sf_small, monkeypatch):
    """no text made of a number, and no second copy of the page's entity, in a shuffle."""
    for entity in ("horse_id", "jockey_id"):
        plan = _landed(monkeypatch, lambda e=entity: L.land_pages(entries(spark, sf_small), "unused", e))
        below = plan[plan.index("RebalancePartitions"):]
        assert "as string)" not in below and "as string)" in plan


def test_landed_pages_are_compressed_and_whole(spark, tmp_path):
    """A page's field names, repeated in every result, do not fill the disk."""
    own = "race_id long, race_date date, course string, distance int, finish_position int, weight double, jockey_id long, horse_id long, ln int"
    rows = [(r, dt.date(2024, 1, 1 + r % 9), f"c{r}", 1000, 1 + r % 7, 50.0, r % 3 or None, r % 11, 1) for r in range(900)]
    df = spark.createDataFrame(rows, own)
    for entity, other in (("jockey_id", "horse_id"), ("horse_id", "jockey_id")):
        at = tmp_path / entity
        L.land_pages(df, str(at), entity, chunk=50)
        files = [p for p in at.rglob("part-*")]
        assert files and all(p.name.endswith(".json.gz") for p in files)
        got = L.read_pages(spark, str(at)).collect()
        want = sorted((str(r["race_id"]), r["race_date"], str(r[entity]), str(r[other]), r["course"]) for r in df.collect())
        assert sorted((r["race_id"], r["race_date"], str(r["entity_id"]), str(r[other]), r["course"]) for r in got) == want


def test_feature_tables_are_made_of_their_own_columns(spark, sf_small, monkeypatch):
    """what both tables are written from holds no column of neither."""
    seen, real = [], QS.staged
    monkeypatch.setattr(QS, "staged", lambda df, name, *a: seen.append(df.columns) or real(df, name, *a))
    load_all()
    assert QUERIES["feature_table_join"](spark, sf_small).count() > 0
    assert seen == [["race_id", "horse_id", "ln", "race_date", "finish_position", "feat_avg_finish"]]


def test_shuffles_move_no_copies(spark, sf_small):
    """What windows read is made above their shuffle, and the cuts of the second
    history come from the rows as written, not from the first one's shuffle."""
    df = spark.range(50).select((F.col("id") % 7).alias("k"), F.col("id").alias("t"), F.col("id").alias("d"))
    plan = _plan(rolling(df, ["k"], ["t"], 5, means={"m": F.col("d") * 2}, lags={"p": F.col("d")}, count_name="c")).splitlines()
    at = next(i for i, line in enumerate(plan) if "RepartitionByExpression" in line)
    assert all(made not in plan[at + 1] for made in ("_v0", "_l0", "_seq_key", "_seq_cuts AS"))
    assert any("_v0" in line for line in plan[:at])
    assert _plan(training(spark, sf_small, SE.staged(runners(spark, sf_small), "test-runners"))).count("RepartitionByExpression") == 2


def test_history_from_written_rows_is_the_same(spark, sf_small):
    a, b = training(spark, sf_small), training(spark, sf_small, SE.staged(runners(spark, sf_small), "test-runners"))
    assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_cuts_from_base_rows(spark, monkeypatch):
    """Also where keys are cut."""
    monkeypatch.setattr(sequence, "CUT_EVERY", 4)
    df = spark.range(400).select((F.col("id") % 3).alias("k"), (F.col("id") % 11).alias("j"), F.col("id").alias("t"), (F.col("id") % 5).alias("d"))
    once = rolling(df, ["k"], ["t"], 5, means={"m": F.col("d")}, count_name="c")
    a = rolling(once, ["j"], ["t"], 5, means={"n": F.col("d")}, lags={"p": F.col("d")}, count_name="e")
    b = rolling(once, ["j"], ["t"], 5, means={"n": F.col("d")}, lags={"p": F.col("d")}, count_name="e", base=df)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and a.count() == 400


def test_scans_are_cut_to_what_a_task_unpacks(spark):
    """A task that shuffles what it scans does not spill it; a cluster's own size stays."""
    before = spark.conf.get(SE._SPLITS)
    try:
        spark.conf.unset(SE._SPLITS)
        assert int(SE.grow_partitions(spark).conf.get(SE._SPLITS)) == SE.MERGED_BYTES
        spark.conf.set(SE._SPLITS, "64m")
        assert SE.grow_partitions(spark).conf.get(SE._SPLITS) == "64m"
    finally:
        spark.conf.set(SE._SPLITS, before)


def test_fits_hold_the_flags_that_say_something(spark):
    """A column never missing in training has no flag; importances go by name."""
    df = spark.range(300).select((F.col("id") % 2).alias("is_win"), F.col("id").alias("a"), F.when(F.col("id") % 2 == 1, 1.0).alias("b"), F.rand(1).alias("c"))
    model = ML.fit_classifier(df, ["a", "b", "c"], "gbt", maxIter=2, maxDepth=2)
    assert model.stages[1].getInputCols() == ["_i_a", "_i_b", "_i_c", "_m_b"]
    imp = {r["feature"]: r["importance"] for r in ML.importances(spark, model, ["a", "b", "c"]).collect()}
    assert abs(imp["b"] - 1) < 1e-9 and imp["a"] == imp["c"] == 0                    # the flag tells the label
    odd = df.withColumn("a", F.lit(None).cast("long"))                               # missing only after training
    assert ML.predict_proba(model, odd, ["a", "b", "c"]).filter("predicted_prob is null").isEmpty()


def test_folds_need_no_keyless_join(spark):
    """AQE keeps the partitions below such a join tiny, and the fits then read one tiny file a task."""
    df = spark.range(60).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 4).cast("int")).alias("race_date"), "id")
    folds = time_folds(df, ["race_date", "id"], 2)
    assert "NestedLoop" not in folds._jdf.queryExecution().executedPlan().toString()
    got = {r["id"]: (r["position"], r["test_fold"]) for r in folds.collect()}
    assert got == {i: (i, (i - 20) // 20 if i >= 20 else None) for i in range(60)}


def test_search_scores_equal_each_fits_own(spark):
    """One pass of metrics over written scores; a fold of one class scores 0.5."""
    df = spark.range(90).select(((F.col("id") % 2) * (F.col("id") < 60).cast("long")).alias("is_win"), F.pmod(F.xxhash64("id"), F.lit(7)).alias("a"),
                                F.col("id").alias("position"), F.when(F.col("id") >= 60, 1).when(F.col("id") >= 30, 0).cast("long").alias("test_fold"))
    params = [{"regParam": 0.01}, {"regParam": 1.0}]
    got = {(r["candidate"], r["fold"]): r["score"] for r in ML.param_search(df, ["a"], df, params, kind="logistic").collect()}
    assert got[0, 1] == got[1, 1] == 0.5 and len(got) == 4
    for c, p in enumerate(params):
        s = ML.predict_proba(ML.fit_classifier(df.filter("id < 30"), ["a"], "logistic", **p), df.filter("id between 30 and 59"), ["a"])
        assert abs(got[c, 0] - ML.classification_metrics(s).filter("metric = 'auc_roc'").first()["value"]) < 1e-9


def test_batches_of_a_search_share_their_folds(spark, monkeypatch):
    """the folds are written and prepared once, not once a batch."""
    df = spark.range(90).select((F.col("id") % 2).alias("is_win"), F.rand(3).alias("a"), F.col("id").alias("position"),
                                F.when(F.col("id") >= 60, 1).when(F.col("id") >= 30, 0).cast("long").alias("test_fold"))
    written, real = [], ML.staged
    monkeypatch.setattr(ML, "staged", lambda x, name, *a: written.append(name) or real(x, name, *a))
    got = PZ.tune(df, ["a"], df, {"maxIter": PZ.Whole(1, 2), "maxDepth": PZ.Whole(1, 2)}, n=3, batch=1, start=2)
    assert got.count() == 6 and written.count("folds") == 1
