"""The pipeline's stages against brute-force versions, each on its own input."""

import random

import corpus_pipeline as cp
from paddock.llm import decontaminate as d
from paddock.llm import langid
from tests.llm.test_cube import _targets
from tests.llm.test_decontaminate import _distance
from tests.llm.test_jaccard import _brute as components
from tests.llm.test_langid import _brute as language
from tests.llm.test_secrets import _base

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents():
    rnd = random.Random(8)
    vocab = {"en": "the and that with from this have which their would".split(), "de": "der und nicht sich eine auch werden durch".split()}
    items = [(i, " ".join(rnd.choice(vocab["en"]) + str(rnd.randrange(90)) for _ in range(12))) for i in range(3)]
    rows = []
    for i in range(160):
        lang = rnd.choice(["en", "en", "de"])
        text = " ".join(rnd.choice(vocab[lang]) + rnd.choice(["", "", "x", "y", "z", "er", "en"]) for _ in range(rnd.randint(1, 60)))
        if i % 9 == 0:
            text += ' token = "' + "".join(rnd.choice("0123456789abcdef") for _ in range(40)) + '"'
        if i % 11 == 0:
            text += " " + items[i % 3][1]
        rows.append([i, text, lang if i % 4 else None, rnd.choice(["a", "a", "b", None]), len(text)])
    rows += [[200 + k, rows[5 + k % 3][1] + " extra", "en", "b", 1] for k in range(12)]
    rows += [[300, None, None, "a", 0], [301, "", "en", "a", 0], [302, "12345 !!", "de", "b", 8], [303, "жщц ъыь " * 60, None, "a", 480], rows[7][:]]
    return [tuple(r) for r in rows], items


def test_stages_equal_brute_force(spark, tmp_path):
    rows, items = _documents()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for k, (_, stage) in enumerate(cp.STAGES):
        before = [tuple(r) for r in docs.select(COLUMNS).collect()]
        if k == 0:
            profiles = langid.train(docs)
        out = stage(spark, docs, str(tmp_path))
        assert out.columns[:5] == COLUMNS
        out.write.parquet(str(tmp_path / f"stage{k}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{k}"))
        seen.append((before, docs.collect()))
    key = lambda r: str(tuple(r)[:5])

    before, after = seen[0]
    keep = []
    for r in before:
        lang, score = language(r[1], profiles, langid.DIM)
        if lang != "und" and not score * (len(r[1]) + cp.HALF) < cp.MIN_SCORE * len(r[1]):
            keep.append(r)
    assert sorted(after, key=key) == sorted(keep, key=key)
    assert {300, 301, 302, 303}.isdisjoint(r[0] for r in after) and len(after) == len(rows) - 4

    before, after = seen[1]
    stay = {i for i, _, c in components([r[:2] for r in before]) if i == c}
    assert sorted(after, key=key) == sorted({r for r in before if r[0] in stay}, key=key)
    assert len(after) < len(before)

    before, after = seen[2]
    bad = {r[0] for r in before for _, b in items if _distance(d.normal(b), d.normal(r[1]))[0] <= int(d.RATE * len(d.normal(b)))}
    assert sorted(after, key=key) == sorted((r for r in before if r[0] not in bad), key=key) and bad

    before, after = seen[3]
    texts = {r[0]: r["text"] for r in after}
    assert sorted(texts) == sorted(r[0] for r in before)
    for r in before:
        assert not [x for x in _base(texts[r[0]]) if x[1]] and ("[SECRET]" in texts[r[0]]) == bool(_base(r[1]))
        assert _base(r[1]) or texts[r[0]] == r[1]
    assert all(r["n_chars"] == len(r["text"]) for r in after)

    before, after = seen[4]
    sizes = {}
    for r in before:
        sizes[r[3]] = sizes.get(r[3], 0) + len(r[1].split())
    taken = {s: sum(r["taken"] for r in after if r["source"] == s) for s in sizes}
    for s, t in _targets(sizes).items():
        assert abs(taken[s] - t) <= 60
    assert all(r["copies"] in (1, 2, 3) and tuple(r)[:5] in set(before) for r in after)


def test_language_id_without_labels(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "the cat", None), (2, "der hund und die katze " * 20, None), (3, "12 !!", None), (4, None, None), (5, "", "en"), (6, "жщц", None)]
    docs = spark.createDataFrame([(*r, "a", 1) for r in rows], schema)
    assert sorted(r["doc_id"] for r in cp.language_id(spark, docs, "").collect()) == [1, 2, 6]
    named = spark.createDataFrame([(1, "the cat", "und", "a", 1), (2, "12", "und", "a", 1)], schema)
    assert [r["doc_id"] for r in cp.language_id(spark, named, "").collect()] == [1]


def test_run(spark, tmp_path):
    rows, items = _documents()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = cp.run(spark, str(tmp_path))
    assert 0 < out.count() < len(rows) and out.columns == [*COLUMNS, "size", "source_size", "target", "copies", "taken"]


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert cp.run(spark, str(tmp_path)).count() == 0
