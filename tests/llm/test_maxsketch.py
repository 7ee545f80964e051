import math
import random
import re
from collections import Counter

import numpy as np

from paddock.llm import maxsketch

DOCS = "doc_id long, text string, term string, n int, item string"
ITEMS = "item_id long, text string, terms string, weight int"


def _terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(maxsketch.TERM, low)


def _brute(docs, items, k=10):
    bags = [(d, Counter(_terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, total = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item_id, text in set(items):
        scored = []
        for d, b in bags:
            m = 10 + 90 * b.total() * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m))
                    for t in set(_terms(text)) if b[t])
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out += [(item_id, r, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def _data():
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["Ünï", "日本語", "ÉÀ", "naïve", "X9", "über"]
    some = lambda n: " ".join(rnd.choice(words) + rnd.choice(["", ".", "-y", "\x7f", "\n"]) for _ in range(n))
    docs = [(i, some(rnd.randint(0, 60))) for i in range(400)]
    docs += [(400 + i, docs[7][1]) for i in range(150)]                          # copies: ties by id
    docs += [(900, None), (901, ""), (902, "... !"), (903, "w1 " * 30_000 + "日本語"), (3, "w3 w3"), (3, "w3 w3"), (None, "w5 w6 naïve")]
    items = [(i, some(rnd.randint(1, 25))) for i in range(30)]
    items += [(30, docs[7][1]), (31, None), (32, "unknown words only"), (33, ""), (5, "second text w3"), items[1], (None, "w5 naïve")]
    return docs, items


def test_terms_of_bytes():
    for text in ("Ab-c D1", "ÉA\x00b", "日本 x　y", "\x7fq", "a_b"):
        assert [t.decode() for t in maxsketch.term_counts(text.encode()).elements()] == list(Counter(_terms(text)).elements())


def test_bounds_are_above_scores():
    docs, items = _data()
    block = maxsketch.Block([{"item": i, "terms": [{"term": t, "weight": 100 + len(t)} for t in set(_terms(text))]}
                             for i, (_, text) in enumerate(items) if _terms(text)])
    for _, text in docs:
        counts = maxsketch.term_counts((text or "").encode())
        if counts:
            up = block.bounds(maxsketch.sketch(counts), 77)
            assert all(u >= maxsketch.exact(t, counts, 77) for u, t in zip(up, block.terms, strict=True))


def test_stops_before_all_are_scored():
    rnd = random.Random(6)
    words = [f"v{i}" for i in range(20_000)]
    docs = []
    for i in range(1500):
        c = Counter(w.encode() for w in rnd.choices(words, k=200))
        docs.append((i, c.total(), maxsketch.sketch(c), b" ".join(c), np.fromiter(c.values(), "<u4").tobytes()))
    terms = [{"term": t.decode(), "weight": 5000} for t in docs[11][3].split(b" ")[:40]]
    best = [[]]
    work = maxsketch.search_batch(maxsketch.Block([{"item": 0, "terms": terms}]), docs, 1500, 300_000, best, 10)
    assert best[0][0][2] == 11 and work < 400


def test_equals_brute_force(spark):
    docs, items = _data()
    d = spark.createDataFrame([(*x, "t", 1, "i") for x in docs], DOCS).repartition(5)
    i = spark.createDataFrame([(*x, "t", 1) for x in items], ITEMS)
    for block_terms in (maxsketch.BLOCK_TERMS, 50):
        got = [tuple(r) for r in maxsketch.search(d, i, block_terms=block_terms).collect()]
        assert sorted(got, key=str) == _brute(docs, items)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "w", "t", 1, "i")], DOCS)
    i = spark.createDataFrame([(1, "w", "t", 1)], ITEMS)
    assert maxsketch.search(d.limit(0), i).count() == 0
    assert maxsketch.search(d, i.limit(0)).count() == 0
    assert maxsketch.search(d, i).columns == ["item_id", "rank", "doc_id", "score"]
