import random

import numpy as np
import pytest

from paddock.llm import cube

SCHEMA = "doc_id long, text string, source string, size string, target int"


def _targets(sizes):
    """Resharing by hand; sizes: source -> size, null last."""
    names = sorted(k for k in sizes if k is not None) + [None] * (None in sizes)
    w = {k: 1 + i % 3 for i, k in enumerate(names)}
    t, total, full = {}, sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[k] for k in full)
        rest = [k for k in names if k not in full]
        t = {k: 3 * sizes[k] for k in full} | {k: left * w[k] / sum(w[x] for x in rest) for k in rest}
        over = {k for k in rest if t[k] > 3 * sizes[k]}
        if not over:
            return t
        full |= over


def test_flight_keeps_totals_and_lands():
    rng = np.random.default_rng(0)
    p, s = rng.random(500), rng.integers(1, 1000, 500)
    out = cube.flight(p, s, rng)
    still = (out > 0) & (out < 1)
    assert still.sum() <= 2
    assert out.sum() == pytest.approx(p.sum()) and (out * s).sum() == pytest.approx((p * s).sum())
    assert set(cube.flight(out, s, rng, land=True)) <= {0.0, 1.0}


def test_inclusion_probabilities_hold():
    p, s = np.array([0.2, 0.5, 0.7, 0.6, 0.4]), np.array([3, 1, 4, 1, 5])
    n = 4000
    mean = sum(cube.flight(p, s, np.random.default_rng(i), land=True) for i in range(n)) / n
    assert np.abs(mean - p).max() < 0.05


def test_mix(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(900):
        src = rnd.choice(["a", "a", "a", "b", "ü", None, "tiny"] if i % 50 else ["void"])
        text = None if src == "void" else "w " * (rnd.randint(1, 3) if src == "tiny" else rnd.randint(0, 60))
        rows.append((i, text, src, "x", 1))
    rows += [rows[3], (None, "x y", "b", None, None), (5000, "long " * 30_000, "a", None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = cube.mix(df, group_rows=40).collect()
    assert len(out) == len(rows)
    sizes, taken, target, longest = {}, {}, {}, {}
    for r in out:
        k = r["source"]
        assert r["size"] == len((r["text"] or "").split())
        assert r["taken"] % max(1, r["size"]) == 0 and r["taken"] <= 3 * r["size"]
        sizes[k] = sizes.get(k, 0) + r["size"]
        taken[k] = taken.get(k, 0) + r["taken"]
        target[k], longest[k] = r["target"], max(longest.get(k, 0), r["size"])
    for k, t in _targets(sizes).items():
        assert target[k] == pytest.approx(t)
        assert abs(taken[k] - t) <= max(60, 2 * (longest[k] if k == "a" else 0))
    assert all(r["source_size"] == sizes[r["source"]] for r in out)
    again = cube.mix(df, group_rows=40).collect()
    key = lambda r: (str(r["doc_id"]), r["taken"])
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_empty_and_wordless(spark):
    df = spark.createDataFrame([(1, None, "a", None, None), (2, " \n", None, None, None)], SCHEMA)
    assert [(r["taken"], r["target"]) for r in cube.mix(df).collect()] == [(0, 0.0)] * 2
    assert cube.mix(df.limit(0)).count() == 0
