import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from paddock.llm import packing, q_packing  # noqa: F401
from paddock.llm.encode import Encoder
from paddock.llm.registry import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, ids int, grp string, row string, number long"
PLAIN = Tokenizer.from_file(PATH)


def _whole(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids + [0]


def _check(pieces, docs, capacity=1024):
    """Every id once, sequences without holes and within capacity; the padding."""
    seen, seqs = {}, {}
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4").tolist()
        assert len(ids) == p["length"] > 0
        seen.setdefault((p["doc_id"], p["doc_tokens"]), []).append((p["start"], ids))
        seqs.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    want = {}
    for doc_id, text in docs:
        ids = _whole(text)
        want.setdefault((doc_id, len(ids)), []).append(ids)
    for key, texts in want.items():
        got = sorted(seen.pop(key))
        assert sorted(i for _, x in got for i in x) == sorted(i for t in texts for i in t)
        if len(texts) == 1:
            assert [i for _, x in got for i in x] == texts[0]
            assert [s for s, _ in got] == np.cumsum([0] + [len(x) for _, x in got])[:-1].tolist()
    assert not seen
    padding = 0
    for parts in seqs.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding


def test_first_fit_is_first_fit():
    rnd = random.Random(1)
    for n in (0, 1, 2, 37, 500):
        sizes = sorted((rnd.randint(1, 100) for _ in range(n)), reverse=True)
        room, want = [], []
        for s in sizes:
            b = next((i for i, r in enumerate(room) if r >= s), len(room))
            if b == len(room):
                room.append(100)
            room[b] -= s
            want.append(b)
        assert packing.first_fit(sizes, 100) == want


@pytest.mark.parametrize("capacity", [64, 100])
def test_groups_need_no_padding_and_lose_nothing(capacity):
    rnd = random.Random(capacity)
    for n in range(1, 60):
        sizes = sorted((rnd.randint(1, capacity - 1) for _ in range(n)), reverse=True)
        seqs = packing.pack_group(sizes, capacity)
        cover = sorted(p for s in seqs for p in s)
        at = {}
        for item, start, length in cover:
            assert length > 0 and at.get(item, 0) == start
            at[item] = start + length
        assert [at[i] for i in range(n)] == sizes
        for s in seqs:
            total = sum(p[2] for p in s)
            assert total == capacity or total & (total - 1) == 0 and total <= capacity


def test_most_documents_stay_whole():
    rnd = random.Random(3)
    sizes = sorted((rnd.randint(1, 1023) for _ in range(4096)), reverse=True)
    seqs = packing.pack_group(sizes, 1024)
    pieces = np.bincount([p[0] for s in seqs for p in s])
    assert (pieces == 1).mean() > 0.9


def test_ids_equal_the_tokenizers():
    enc = Encoder(PATH)
    assert enc.cuts
    rnd = random.Random(7)
    some = ["a", "Ab", " ", "  ", "\n", "\t", ".", ",\n", "é", "ü.", "1", "12", "'s", "'", "_", "\x1f", "\x85", "\xa0", "　",
            "漢字", "<|endoftext|>", "²", "½", "̀", "🙂", "don't", "--", "\r\n", "x" * 90, "\x00", "ß", " "]
    for _ in range(1500):
        text = "".join(rnd.choice(some) for _ in range(rnd.randint(0, 12)))
        assert np.frombuffer(enc.ids(text), enc.dtype).tolist() == PLAIN.encode(text, add_special_tokens=False).ids, repr(text)


def test_pack_with_odd_rows(spark):
    rnd = random.Random(2)
    docs = [(i, " ".join(rnd.choice(["alpha", "beta,", "γ", "x"]) for _ in range(rnd.randint(0, 400)))) for i in range(300)]
    docs += [(300, None), (301, ""), (302, " \n "), (303, "long words " * 20_000), (5, "again"), (5, "again"), (None, "no id"),
             (304, "x" * 5000)]
    df = spark.createDataFrame([(*d, 1, "g", "r", 2) for d in docs], SCHEMA)
    pieces = packing.pack(df, PATH, group_rows=50).collect()
    assert _check(pieces, docs) == 0
    whole = packing.sequences(packing.pack(df, PATH, group_rows=50)).collect()
    assert sum(r["n_tokens"] for r in whole) == sum(len(_whole(t)) for _, t in docs)
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in whole)
    assert packing.pack(df.limit(0), PATH).count() == 0
    assert {(p["length"], p["doc_tokens"]) for p in packing.pack(df.filter("doc_id in (300, 301)"), PATH).collect()} == {(1, 1)}


def test_query(spark, sf_small):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    got = QUERIES["op13_packing"](spark, sf_small).collect()
    covered, fill = {}, {}
    for r in got:
        ids = _whole(docs[r["doc_id"]])
        assert r["doc_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes())
        covered[r["doc_id"]] = covered.get(r["doc_id"], 0) + r["length"]
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert covered == {k: len(_whole(t)) for k, t in docs.items()}
    assert all(n <= 1024 and (n == 1024 or n & (n - 1) == 0) for n in fill.values())
