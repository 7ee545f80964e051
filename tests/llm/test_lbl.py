import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paddock.llm import lbl
from paddock.llm.q_lbl import op5_lm_score

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def _check(rows, out, learn):
    c = Counter()
    for i, t in rows:
        if learn(i):
            c.update([*_tokens(t), None])
    n, v = sum(c.values()), len(c)
    want = []
    for i, t in rows:
        x = [*_tokens(t), None]
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in x)
        want.append((i, len(x), sum(c[w] > 0 for w in x), base))
    got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"]) for r in out), key=str)
    for a, b in zip(sorted(want, key=str), got, strict=True):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3])
    return n


def test_counts_and_base_score(spark):
    words = [f"w{k}" for k in range(40)]
    rows = [(i, " ".join(words[(i * k) % 40] for k in range(30 + i % 7))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "New\tWORDS\x0bhere É é x"), (203, "w1 " * 50_000), (3, rows[3][1]), (None, "w1 odd")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, c int")
    learn = F.col("doc_id").isNotNull() & (F.col("doc_id") % 7 != 2)
    for head in (1 << 17, 10, 0):
        out, counts = lbl.train_and_score(df, learn, head=head, vocab=16, dim=8)
        out = out.collect()
        assert counts.n == _check(rows, out, lambda i: i is not None and i % 7 != 2)
        assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in out)


def test_probabilities_are_normalised_and_learned(spark):
    rows = [(i, "a b c d " * 40) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    c = lbl.count(df.select("text"), vocab=16)
    m = lbl.fit(df.select("text"), df.select("text").limit(20), lbl.new_model(c, 8))
    n, a, b, d = len(m.params[0]), m.vocab[b"a"], m.vocab[b"b"], m.vocab[b"d"]
    assert n == 1 + lbl.TAILS + 4 and len(m.vocab) == 5
    for w2 in (0, a, d, m.vocab[lbl.END], n - 1):
        for w1 in (0, a, n - 1):
            p = np.exp(lbl.log_probs(m, np.full(n, w2), np.full(n, w1), np.arange(n)))
            assert p.sum() == pytest.approx(1, abs=1e-4)
    assert lbl.log_probs(m, np.array([d]), np.array([a]), np.array([b]))[0] > math.log(0.5)


def test_vocabulary_grows_and_keeps_tails(spark):
    rows = [(i, " ".join(f"w{(i * k) % (i + 1)}x{k % 7}" for k in range(60)) + " " + "y" * 200 + str(i % 3)) for i in range(200)]
    rows += [(200, "ab " + "z" * 500_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    c = lbl.count(df.select("text"))
    seen = Counter(w for _, t in rows for w in lbl._words(t.encode()))
    assert max(map(len, seen)) <= lbl.LONG and c.vocab == math.ceil(lbl.ROOT * math.sqrt(len(seen))) < len(seen)
    top = sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:c.vocab]
    assert list(c.head.items())[:c.vocab] == top
    want = np.zeros((2, lbl.TAILS))
    for w in seen.keys() - dict(top).keys():
        want[:, lbl._tail(w)] += seen[w], 1
    assert (c.tails == want).all()
    m = lbl.new_model(c)
    assert np.bincount(m.cls).tolist() == np.diff(m.lo).tolist() and len(m.lo) > math.sqrt(len(m.cls)) / 2
    assert sorted([*m.vocab.values(), *m.tail]) == list(range(len(m.cls)))
    lists = [np.exp(m.log_inner[a:b]).sum() for a, b in zip(m.lo, m.lo[1:])]
    assert np.allclose(lists, 1) and np.exp(m.log_class).sum() == pytest.approx(1)


def test_warm_rows_are_few_with_repeated_ids(spark):
    df = spark.createDataFrame([(None, "same")] * 300 + [(None, f"t{i}") for i in range(100)], "doc_id long, text string")
    warm = lbl.warm_rows(df, "doc_id", "text", 50)
    assert 1 <= warm.count() <= 50 and warm.distinct().count() == warm.count()
    assert "Coalesce" not in df._sc._jvm.PythonSQLUtils.explainString(warm._jdf.queryExecution(), "simple")


def test_empty_training(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    out, c = lbl.train_and_score(df, F.lit(False))
    assert c.n == 0 and sorted((r["n_tokens"], r["n_known"], r["base_score"]) for r in out.collect()) == [(1, 0, 0.0), (3, 0, 0.0)]
    assert lbl.train_and_score(df.limit(0), F.lit(True))[0].count() == 0


ODD = [None, b"", b" ", b"\t\n\x0b\x0c\r a\x1cB\x1d \x1e\x1fC\xc2\x85d\xc2\xa0 \xc3\x89 \x00 e", b"a  b", b" a A ", b"\xff\xfe A\xff",
       b"x" * 60 + b" Y " + b"X" * 60 + b" " + b"z" * 49 + b" " + b"z" * 48, b"a " * 500, b"b"]


def test_texts_are_encoded_by_distinct_word(monkeypatch):
    asked = []

    class Numbers(lbl._Numbers):
        def __missing__(self, word):
            asked.append(word)
            return super().__missing__(word)

    want = [lbl._words(t) for t in ODD]
    for rows, chunk, size in ((100, 1 << 18, 1 << 20), (3, 7, 1 << 20), (100, 1 << 18, 20)):
        monkeypatch.setattr(lbl, "_CHUNK", chunk)
        monkeypatch.setattr(lbl, "_BYTES", size)
        all_ = pa.RecordBatch.from_arrays([pa.array(ODD, pa.binary()), pa.array(range(len(ODD)))], ["t", "i"])
        batches = [all_.slice(i, rows) for i in range(0, len(ODD), rows)]
        asked.clear()
        out = list(lbl._encoded(iter(batches), Numbers({lbl.END: 0, b"a": 1}), rest=True))
        if size > 1000 and rows == 100:
            assert len(asked) == len(set(asked))                 # once for a batch's distinct words
        ids = [x.tolist() for _, i, s, _ in out for x in np.split(i, s[1:])]
        assert ids == [[1 if w == b"a" else -1 - lbl._tail(w) for w in x] + [0] for x in want]
        assert [v for p, *_ in out for b in p for v in b.column(1).to_pylist()] == list(range(len(ODD)))
        rest = [v for *_, u in out for v in pa.concat_arrays(u).to_pylist()]
        assert [{x["word"]: x["tf"] for x in v} for v in rest] == [Counter(w for w in x if w != b"a") for x in want]


def test_sums_equal_reduceat():
    rng = np.random.default_rng(3)
    x, ids = rng.normal(size=(500, 5)).astype(np.float32), np.sort((200 ** rng.random(500)).astype(int))
    order, begin = rng.permutation(500), lbl._starts(ids)
    assert (lbl._sums(x, begin) == np.add.reduceat(x, begin, axis=0)).all()
    assert (lbl._sums(x, begin, order) == np.add.reduceat(x[order], begin, axis=0)).all()


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    out = op5_lm_score(spark, sf).collect()
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    n = _check(docs, out, lambda i: not held(i))
    assert {r["train_tokens"] for r in out} == {n} and all(r["held_out"] == held(r["doc_id"]) for r in out)
    test = [r for r in out if r["held_out"]]
    assert sum(r["score"] for r in test) > sum(r["base_score"] for r in test)
