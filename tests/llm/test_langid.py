import numpy as np
import pytest

from paddock.llm import langid
from paddock.llm.common import crc_mod
from paddock.llm.q_langid import op2_language_id

SCHEMA = "doc_id long, text string, lang string, lang_pred string"


def _brute(text, profiles, dim):
    """Trigram by trigram, in plain loops."""
    s = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    if not s.strip():
        return "und", 0.0
    s = " " + " ".join(s.split()) + " "
    vec = {c: langid.letter_vectors(np.array([ord(c)]), dim)[0].astype(int) for c in set(s)}
    v = np.zeros(dim)
    for a, b, c in zip(s, s[1:], s[2:], strict=False):
        v += np.roll(vec[a], 2) * np.roll(vec[b], 1) * vec[c]
    cos = profiles.matrix @ v / np.linalg.norm(v)
    return profiles.langs[int(cos.argmax())], float(min(1, max(0, cos.max())))


def test_matches_brute_force_and_edge_cases(spark):
    rows = [(1, "the cat and the dog", "en", "x"), (2, "der hund und die katze", "de", "x"),
            (3, None, "en", "x"), (4, "", None, None), (5, "123 !!", "de", None),
            (6, "the dog " * 60_000, None, None), (7, "THE Cat", None, None), (7, "THE Cat", None, None),
            (8, "日本語のテキスト", "ja", None), (None, "die katze", None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    p = langid.train(df)
    assert p.langs == ["de", "en", "ja"]
    out = langid.predict(df, p).collect()
    assert len(out) == len(rows)
    for r in out:
        want, score = _brute(r["text"] if r["doc_id"] != 6 else "the dog " * 60_000, p, langid.DIM)
        assert r["lang_pred"] == want
        assert r["score"] == pytest.approx(score, abs=1e-6)
    assert {r["doc_id"] for r in out if r["lang_pred"] == "und"} == {3, 4, 5}


def test_empty_table_and_nothing_learned(spark):
    df = spark.createDataFrame([], SCHEMA)
    p = langid.train(df)
    assert p.langs == [] and langid.predict(df, p).count() == 0
    one = spark.createDataFrame([(1, "abc", None, None)], SCHEMA)
    assert langid.predict(one, p).first()["lang_pred"] == "und"


def test_held_out_accuracy(spark):
    out = op2_language_id(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = out.filter("held_out").join(docs, "doc_id").toPandas()
    assert out.count() == docs.count() and len(held) > 100
    assert (held.lang == held.lang_pred).mean() > 0.98
    assert out.filter(crc_mod("doc_id", 5).eqNullSafe(0) != out.held_out).count() == 0
