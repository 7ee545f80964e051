import math
import random

import numpy as np
from pyspark.sql import functions as F

from paddock.llm import pivots

SCHEMA = "vec_id long, embedding array<float>, score string"


def _brute(rows, k, step):
    v = {(i, tuple(math.floor(1024 * float(np.float32(x))) for x in e)) for i, e, _ in rows
         if i is not None and e and all(x is not None and math.isfinite(x) for x in e)}
    out = []
    for qi, q in v:
        if qi % step == 0:
            s = sorted((-sum(a * b for a, b in zip(q, c, strict=True)), ci)
                       for ci, c in v if ci != qi and len(c) == len(q))[:k]
            out += [(qi, r, ci, -x) for r, (x, ci) in enumerate(s, 1)]
    return sorted(out)


def test_equals_brute_force(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.gauss(0, 0.2) for _ in range(8)], "x") for i in range(150)]
    rows += [(200 + i, [0.5] * 8, None) for i in range(30)]                 # ties
    rows += [rows[4], (None, [1.0] * 8, None), (300, None, None), (301, [], None),
             (302, [float("nan")] * 8, None), (303, [None] * 8, None), (304, [float("inf")] * 8, None),
             (310, [1.0, 2.0], None), (311, [2.0, 2.0], None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = pivots.top_k(df, F.col("id") % 10 == 0, k=5, pivots=6, block_rows=40, query_rows=7)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == _brute(rows, 5, 10)


def test_large_components_and_repeated_ids(spark):
    rnd = random.Random(5)
    def at(scale):
        return [float(np.float32(rnd.gauss(0, 1) * scale)) for _ in range(8)]
    rows = [(i, at(10.0 ** (i % 9 * 4)), "x") for i in range(160)]           # up to 10^32: no long holds the scores
    rows += [(400 + i, at(20000.0), None) for i in range(40)]
    rows += [(500, [3e38] * 8, None), (501, [3.1e38] * 8, None), (502, [-3e38] * 8, None), (510, [1.0] * 8, None)]
    rows += [(20, at(1.0), None), (33, at(30000.0), None)]                    # further vectors of known ids
    df = spark.createDataFrame(rows, SCHEMA)
    got = pivots.top_k(df, F.col("id") % 10 == 0, k=300, pivots=6, block_rows=40, query_rows=7)
    want = [(q, r, c, min(max(s, -2 ** 63), 2 ** 63 - 1)) for q, r, c, s in _brute(rows, 300, 10) if q != 20]
    assert sorted(tuple(r) for r in got.collect() if r[0] != 20) == want
    # both vectors of id 20 share one ranking: the k best pairs
    pairs = sorted((-s, c) for q, r, c, s in _brute(rows, 300, 10) if q == 20)[:300]
    both = [(c, s) for q, r, c, s in sorted(map(tuple, got.collect())) if q == 20]
    assert both == [(c, min(max(-s, -2 ** 63), 2 ** 63 - 1)) for s, c in pairs]


def test_bounds_hold_for_close_and_for_huge_vectors():
    rng = np.random.default_rng(2)
    for base, spread in ((0, 1e3), (1e9, 3), (1e13, 1e5), (1e40, 1e30)):
        c = np.floor(base + rng.normal(0, spread, (300, 16)))
        up = pivots._bounds(c[:20], c, c[::60])
        for i in range(20):
            assert all(float(u) >= int(s) for u, s in zip(up[i], pivots._products(c[i], c), strict=True))


def test_fewer_than_k_and_empty(spark):
    one = spark.createDataFrame([(0, [1.0], None), (1, [2.0], None)], SCHEMA)
    assert [tuple(r) for r in pivots.top_k(one, F.col("id") == 0).collect()] == [(0, 1, 1, 1024 * 2048)]
    assert pivots.top_k(one.limit(0), F.col("id") == 0).count() == 0


def test_stops_early():
    rng = np.random.default_rng(1)
    c = np.floor(np.concatenate([rng.normal(k, 0.05, (2000, 4)) for k in range(5)]) * 1024)
    q = c[8000:8004]
    ids = np.arange(len(c))
    *_, work = pivots.search_cell(ids[8000:8004], q, ids, c, c[::500], 10)
    assert work < 0.6 * 4 * len(c)
