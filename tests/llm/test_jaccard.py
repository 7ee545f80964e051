import random
import re

import numpy as np
import pyarrow as pa
import pytest

from paddock.llm import jaccard
from paddock.llm.components import components
from paddock.llm.q_jaccard import op8_ngram_jaccard
from paddock.llm.shingles import batch_sets

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def _brute(rows):
    """doc id -> (sizes, component), all pairs through an inverted index."""
    sets = sorted({_set(t) for _, t in rows} - {frozenset()}, key=sorted)
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    index = {}
    for i, s in enumerate(sets):
        shared = {}
        for x in s:
            for j in index.setdefault(x, []):
                shared[j] = shared.get(j, 0) + 1
            index[x].append(i)
        for j, c in shared.items():
            if 100 * c >= 80 * (len(s) + len(sets[j]) - c):
                root[find(i)] = find(j)
    of = {s: find(i) for i, s in enumerate(sets)}
    low = {}
    for i, t in rows:
        if i is not None and _set(t):
            low[of[_set(t)]] = min(low.get(of[_set(t)], i), i)
    return sorted(((i, len(_set(t)), low.get(of[_set(t)]) if _set(t) else i) for i, t in rows), key=str)


def _family(rnd, rows, start, base, n, most):
    for k in range(n):
        w = list(base)
        for _ in range(rnd.randint(0, most)):
            at = rnd.randrange(len(w))
            w[at:at + rnd.randint(0, 2)] = [f"e{rnd.randrange(10**6)}"] * rnd.randint(0, 2)
        rows.append((start + k, " ".join(w)))


def _corpus(seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 80)))) for i in range(150)]
    passage = [rnd.choice(words) for _ in range(60)]
    for k in range(40):                              # a passage that many share
        rows.append((500 + k, " ".join([rnd.choice(words) for _ in range(rnd.randint(5, 60))] + passage)))
    for f in range(6):
        _family(rnd, rows, 1000 + 100 * f, [rnd.choice(words) for _ in range(rnd.randint(20, 120))], 60, 6)
    rows += [(3000 + k, rows[160][1].upper()) for k in range(30)]
    rows += [(4000, None), (4001, ""), (4002, " \n\t"), (4003, "one"), (4004, "ONE"), (4005, "a b c d"), (4006, "a b c d e"),
             (4007, "é b c d e f"), (4008, "É b c d e f"), (4009, "x " * 30_000), (4010, "a b c d"), (4011, "a\x0bb\x1cc d e f"),
             rows[5], (None, rows[200][1])]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,cost,spread", [(1, 16, 100_000), (2, 2, 100_000), (3, 256, 4)])
def test_equals_brute_force(spark, monkeypatch, seed, cost, spread):
    monkeypatch.setattr(jaccard, "COST", cost)        # longer prefixes
    monkeypatch.setattr(jaccard, "SPREAD", spread)    # dealt lists
    rows = _corpus(seed)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, node string, n int").repartition(4)
    got = jaccard.join(df)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == _brute(rows)


def test_unknown_sets_by_join(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "MAX_KNOWN", 3)
    rows = _corpus(4)
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == _brute(rows)


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op8_ngram_jaccard(spark, sf).collect()), key=str) == _brute(rows)


def test_keep_one(spark):
    rows = _corpus(5)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [r["doc_id"] for r in jaccard.keep_one(df).collect()]
    want = {(i, c) for i, _, c in _brute(rows)}
    assert sorted(map(str, kept)) == sorted(str(i) for i, c in want if i == c or i is None)


def test_keep_one_judges_rows(spark):
    a, b, c, e = (" ".join(f"{x}{k}" for k in range(40)) for x in "abce")
    rows = [(1, a), (5, a.upper()), (5, b), (7, b + " x"), (5, b), (2, c), (2, c + " y"), (None, e), (None, e), (None, e + " z"),
            (None, ""), (None, ""), (8, ""), (8, "")]
    kept = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    ids = sorted((r["doc_id"] or 0, (r["text"] or "-")[:2]) for r in kept)
    assert ids == [(0, "-"), (0, "-"), (0, "e0"), (1, "a0"), (2, "c0"), (5, "b0"), (8, "-")]


def test_sets_do_not_depend_on_the_batch():
    texts = [b"a b c d e f", None, b"", b"  x", b"a b c d e f g A B C D E F", "é ü".encode(), b"end"]
    whole = next(batch_sets(pa.array(texts, pa.binary())))[1]
    for i, t in enumerate(texts):
        alone = next(batch_sets(pa.array([b"zz y", t], pa.binary()).slice(1)))[1][0]
        assert np.array_equal(alone, whole[i])
    assert [len(s) for s in whole] == [2, 0, 0, 1, 7, 1, 1]


def test_components(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, k) for k in range(501, 700)] + [(7, 7), (9, 8), (8, 9)]
    rnd.shuffle(edges)
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    want = {i: 100 for i in range(100, 161)} | {k: 500 for k in range(500, 700)} | {8: 8, 9: 8}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.join(df).count() == 0 and jaccard.keep_one(df).count() == 0
