"""Operators on tables with further columns of any name, and on long texts."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from paddock.llm import cube, jaccard, langid, maxsketch, packing, secrets
from paddock.llm.q_packing import public_tokenizers
from paddock.llm.registry import prepare

EXTRA = ["n", "p", "whole", "src", "extra", "_id", "_tag", "row", "score", "node", "bucket", "grp", "h", "words", "_row", "_kept", "id"]


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    words = "the and that with from this have which their would".split()
    rows = [(i, " ".join(words[(i * k + k * k) % 10] + str(i * k % 17) for k in range(1, 30)), "en" if i % 3 else "de", "s" + str(i % 2), 100)
            for i in range(60)]
    rows += [(60, rows[3][1], "en", "s0", 1), (None, rows[3][1], None, None, None)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return plain, plain.withColumns({c: F.lit(f"x{i}") for i, c in enumerate(EXTRA)})


def _same(a, b):
    cols = a.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.select(cols).collect()))


def test_stages_keep_further_columns(spark, docs, tmp_path):
    plain, wide = docs
    spark.createDataFrame([(1, "some benchmark item of enough words")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in cp.STAGES:
        a, b = stage(spark, plain, str(tmp_path)), stage(spark, wide, str(tmp_path))
        assert set(wide.columns) <= set(b.columns), name
        _same(a, b)
        assert b.filter(" or ".join(f"cast(`{c}` as string) <> 'x{i}'" for i, c in enumerate(EXTRA))).count() == 0


def test_operators_ignore_further_columns(spark, docs):
    plain, wide = docs
    items = spark.createDataFrame([(1, "the1 and2 that3", "t", 2)], "item_id long, text string, term string, weight int")
    path = public_tokenizers.path("byte_bpe_50k.json")
    for f in (lambda d: jaccard.join(d), lambda d: langid.predict(d, langid.train(d)).select("doc_id", "lang_pred"),
              lambda d: secrets.scan(d, secrets.train(secrets.samples(d))) if hasattr(secrets, "scan") else d.select("doc_id"),
              lambda d: maxsketch.search(d, items), lambda d: packing.pack(d, path).select("doc_id", "start", "length"),
              lambda d: cube.mix(d, keep=["doc_id"]).select("doc_id", "size", "target")):
        _same(f(plain), f(wide))


def test_batches_are_bounded_by_bytes(spark):
    prepare(spark)
    big = spark.range(200, numPartitions=1).select(F.repeat(F.lit("x"), 1_000_000).alias("text"))
    most = big.mapInArrow(lambda bs: (b.__class__.from_pydict({"n": [b.num_rows]}) for b in bs), "n long").agg(F.max("n")).first()[0]
    assert most <= 100                                   # of 200: Spark closes a batch some way past the bound
