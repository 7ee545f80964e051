import base64
import hashlib

import pytest

from paddock.llm import warc

SCHEMA = "page_id long, url string, html string, digest string"


def _digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip(spark, tmp_path):
    odd = ["a", "é" * 3, None, "", "x\r\n\r\ny", "\r\n", "tail\r\n", "\r\n\r\n", "WARC/1.1\r\nWARC-Type: response\r\n\r\n",
           "line\nline\r" + "z" * 300_000, "a", "a", ""]
    rows = [(100 - i, f"http://h/{i}" if i else None, t, "x") for i, t in enumerate(odd)]
    rows += [(5, "u", "same", None)] * 3 + [(6, "u", "same", None), (None, "v", "same", None), (None, "w", "lone\r\nurl", None)]
    warc.write_archives(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "a"))
    out = warc.read_archives(spark, str(tmp_path / "a"), payloads=True).collect()
    assert len(out) == len(rows)
    first = {}
    for i, u, t, _ in rows:
        d = _digest(t)
        if i is not None:
            first[d] = min(first.get(d, i), i)
    got = sorted((str(r["page_id"]), r["payload_digest"], r["payload_bytes"]) for r in out)
    assert got == sorted((str(i), _digest(t), len((t or "").encode())) for i, _, t, _ in rows)
    by = {}
    for r in out:
        by.setdefault(r["payload_digest"], []).append(r)
    for d, rs in by.items():
        original = [r for r in rs if r["record_type"] == "response"]
        assert len(original) == 1 and original[0]["page_id"] == first.get(d)
        assert _digest(original[0]["payload"]) == d
        assert all(r["refers_to"] == first.get(d) and r["payload"] is None for r in rs if r["record_type"] == "revisit")
    assert len({r["record_id"] for r in out}) == len(out)


def test_min_bytes_and_empty_table(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "ab", None), (2, "u", "ab", None), (3, "u", "abcd", None), (4, "u", "abcd", None)], SCHEMA)
    warc.write_archives(df, str(tmp_path / "a"), min_bytes=3)
    out = {r["page_id"]: r["record_type"] for r in warc.read_archives(spark, str(tmp_path / "a")).collect()}
    assert out == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    warc.write_archives(df.limit(0), str(tmp_path / "b"))
    assert warc.read_archives(spark, str(tmp_path / "b")).count() == 0


def test_truncated_archive_raises():
    with pytest.raises(ValueError):
        list(warc.parse([b"WARC/1.1\r\nContent-Length: 50", b"short"]))
