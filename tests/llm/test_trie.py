import hashlib
import random
import zlib

import pytest

from paddock.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, n int, q string, depth string"


def _rebuild(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    return out


def _brute(rows):
    convs = _rebuild(rows)
    nodes = {}
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(seq[:d], []).append(c)
    kids = {}
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(members) - 1) * (len(p[-1][1]) if p else 0)
    out = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == len(p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(kids.get(p, [])), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def _rows(seed):
    rnd = random.Random(seed)
    rows = []
    for c in [*range(-120, 260, 3), *range(300, 420), 2**40, -2**40]:
        if c in (-100, 200):
            continue
        for t in range(rnd.choice([1, 2, 3, 5, 8, 9])):
            rows.append((c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["hello", "hi", "x", "é" * 9, None, ""])))
    for c in range(1000, 1160):                                  # a group of exact copies
        rows += [(c, t, "user", f"copy {t}") for t in range(11)]
    for c in (1200, 1207, 1300, 1301):                           # long ones that share long prefixes
        rows += [(c, t, "user", f"turn {t % 5}") for t in range(57 + c % 4)]
    rows += [(1400, None, "b", "null turn"), (1400, None, "a", "null turn"), (1400, 3, None, None), rows[5], rows[5]]
    rows += [(None, 1, "user", "no id"), (1401, 1, "user", "z" * 100_000)]
    rows += [(1500, t, "user", "w" * (t % 7)) for t in range(700)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("width,block_rows", [(16, 32_768), (3, 7), (1, 50)])
def test_equals_brute_force(spark, width, block_rows):
    rows = _rows(width)
    df = spark.createDataFrame([(*r, 1, "q", "d") for r in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in trie.trie(df, width=width, block_rows=block_rows).collect()]
    assert sorted(got, key=str) == _brute(rows)


def test_empty_and_turnless(spark):
    c = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6)     # its turn gives way to a conversation that is not there
    df = spark.createDataFrame([(c, 0, "user", "only", 1, "q", "d")], SCHEMA)
    assert trie.trie(df.limit(0)).count() == 0
    got = [tuple(r) for r in trie.trie(df).collect()]
    assert got == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
