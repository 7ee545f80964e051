"""WARC archives with revisit resolution.

Headers first: one narrow row per page (id, url, SHA-1 digest and length of the
payload) is counted per identical header and shuffled by digest. Each digest
that occurs again, with a payload of at least ``min_bytes``, gets an original:
the row of smallest page id (then url; nulls last). Revisit records are made
from the headers alone. The payload rows only learn whether they are an
original: they are joined with the repeated digests on (digest, salt), where a
digest's entry is copied to all salts, so a digest that holds a third of all
rows is spread. The repeated digests are written first: where their files are
below Spark's broadcast threshold, no payload is shuffled. Payloads of revisits
are dropped in the join.

Archives are gzip files of WARC/1.1 records written by Spark's text writer, in
which the record separator CRLF CRLF is the line separator; so they go wherever
Spark can write. The reader gets pieces between separators, in file order, and
cuts records by their Content-Length, whatever the payload holds; it holds one
record at a time and checks the digest of every payload.

Nulls and ties: null html is an empty payload, a null url or page id is left
out of the record. Of identical rows one is the original and the others revisit
it. Page ids are compared as they are (numbers by value).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm.common import stored

SALTS = 32
_END = "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hex digits make four letters."""
    h = F.sha1(payload)
    part = [F.lpad(F.conv(F.substring(h, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*part), "0123456789ABCDEFGHIJKLMNOPQRSTUV", _BASE32)


def _headers(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    payload = F.coalesce(F.col(html).cast("string"), F.lit(""))
    body = payload.cast("binary")
    return pages.select(F.col(page_id).alias("id"), F.col(url).cast("string").alias("url"), payload.alias("payload"),
                        base32_sha1(body).alias("digest"), F.octet_length(body).cast("long").alias("bytes"))


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in (
        (1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing for a null; line breaks in a value are escaped."""
    v = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), v, F.lit("\r\n")), F.lit(""))


def _record(kind: str, fields: list[Column], http: Column, payload: Column, date: str) -> Column:
    block = F.concat(http, F.lit(_END), payload)
    return F.concat(
        F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Date: {date}\r\n"), *fields,
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block.cast("binary")).cast("string"), F.lit(_END), block)


def _common(copy: Column) -> list[Column]:
    return [_field("WARC-Record-ID", _uuid(F.col("id"), F.col("url"), F.col("digest"), copy)),
            _field("WARC-Target-URI", F.col("url")),
            _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
            _field("X-Payload-Length", F.col("bytes")), _field("X-Page-ID", F.col("id"))]


def records(pages: DataFrame, min_bytes: int = 0, page_id: str = "page_id", url: str = "url",
            html: str = "html", date: str | None = None) -> DataFrame:
    """(value): one WARC record per row of ``pages``, duplicates as revisits."""
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = _headers(pages, page_id, url, html)
    order = F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"),
                     F.col("url").isNull().alias("no_url"), F.col("url").alias("url"))
    same = rows.groupBy("id", "url", "digest", "bytes").agg(F.count(F.lit(1)).alias("n"))
    again = (same.filter(F.col("bytes") >= min_bytes).groupBy("digest")
             .agg(F.min(order).alias("first"), F.min_by("n", order).alias("copies"), F.sum("n").alias("total"))
             .filter("total > 1").withColumnRenamed("digest", "d"))
    again = stored(again, "warc-repeats")            # its size is known before payloads are joined
    salt = lambda: F.pmod(F.xxhash64("id", "url"), F.lit(SALTS))
    spread = again.withColumn("salt_d", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    first = F.col("id").eqNullSafe(F.col("first.id")) & F.col("url").eqNullSafe(F.col("first.url"))
    hit = (F.col("digest") == F.col("d")) & (salt() == F.col("salt_d"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"))
    kept = rows.join(spread, hit, "left").filter(F.col("d").isNull() | first)
    cols = ["id", "url", "payload", "digest", "bytes"]
    single = kept.filter(F.col("d").isNull() | (F.col("copies") == 1)).select(cols)
    several = kept.filter(F.col("copies") > 1).select(cols).dropDuplicates(["id", "url", "digest"])
    responses = single.unionByName(several).select(
        _record("response", _common(F.lit(0)), http, F.col("payload"), date).alias("value"))
    left = F.col("n") - F.when(first, 1).otherwise(0)
    refers = [_field("WARC-Profile", F.lit(_PROFILE)),
              _field("WARC-Refers-To", _uuid(F.col("first.id"), F.col("first.url"), F.col("digest"), F.lit(0))),
              _field("WARC-Refers-To-Target-URI", F.col("first.url")),
              _field("X-Refers-To-Page-ID", F.col("first.id"))]
    revisits = (same.join(spread, hit).filter(left > 0).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), left)))
                .select(_record("revisit", _common(F.col("copy")) + refers, F.lit("HTTP/1.1 200 OK"), F.lit(""), date).alias("value")))
    return responses.unionByName(revisits)


def write_archives(pages: DataFrame, path: str, **options) -> None:
    records(pages, **options).write.option("lineSep", _END).option("compression", "gzip").text(path)


def parse(pieces: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of a stream given in pieces
    between separators."""
    end = _END.encode()
    parts: list[bytes] = []
    size, need = 0, 0
    for piece in pieces:
        parts += (piece, end)
        size += len(piece) + len(end)
        while size and size >= need:
            data = b"".join(parts)
            cut = data.find(end)
            if cut < 0:
                break
            lines = data[:cut].decode("utf-8").split("\r\n")
            fields = dict(x.split(": ", 1) for x in lines[1:])
            if not lines[0].startswith("WARC/") or "Content-Length" not in fields:
                raise ValueError("not a WARC record")
            stop = cut + len(end) + int(fields["Content-Length"])
            need = stop + len(end)
            if size >= need:
                yield fields, data[cut + len(end):stop]
                data = data[need:]
                need = 0
            parts, size = [data], len(data)
    if size:
        raise ValueError("the archive ends within a record")


def read_archives(spark: SparkSession, path: str, id_type: str = "long", payloads: bool = False) -> DataFrame:
    """One row per record: page_id, url, payload_bytes, payload_digest,
    record_type, refers_to, record_id (and payload, null for revisits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id"]
        types = [pa.string(), pa.string(), pa.int64(), *[pa.string()] * 4]
        if payloads:
            names, types = [*names, "payload"], [*types, pa.string()]

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

        rows, size = [], 0
        for f, block in parse(x.as_py() for b in batches for x in b.column(0)):
            body = block.split(b"\r\n\r\n", 1)[1]
            digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
            kind = f["WARC-Type"]
            if kind == "response" and base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
                raise ValueError(f"payload digest differs: {f['WARC-Record-ID']}")
            row = [f.get("X-Page-ID"), f.get("WARC-Target-URI"), int(f["X-Payload-Length"]), digest, kind,
                   f.get("X-Refers-To-Page-ID"), f["WARC-Record-ID"]]
            if payloads:
                row.append(body.decode("utf-8") if kind == "response" else None)
            rows.append(row)
            size += len(block) if payloads else 200
            if size > 8 << 20:
                yield out(rows)
                rows, size = [], 0
        if rows:
            yield out(rows)

    schema = ("page_id string, url string, payload_bytes long, payload_digest string, record_type string, "
              "refers_to string, record_id string" + ", payload string" * payloads)
    text = spark.read.option("lineSep", _END).text(path).select(F.col("value").cast("binary"))
    return (text.mapInArrow(run, schema)
            .withColumn("page_id", F.col("page_id").cast(id_type)).withColumn("refers_to", F.col("refers_to").cast(id_type)))
