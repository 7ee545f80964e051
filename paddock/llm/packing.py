"""Packing documents into sequences: first-fit decreasing with a tournament tree.

A document is its token ids and an end id. Whole runs of ``capacity`` ids are
sequences of their own; what is left of each document, fewer than ``capacity``
ids, is packed. Documents are dealt into groups by a hash of their row, so a
group holds about ``group_rows`` rows at random whatever the table's order, hot
sources or sizes, and each group is packed by itself:

1. First-fit decreasing: the longest rest first, each into the first bin with
   room. A tournament tree over the bins' free room finds that bin: an inner
   node holds the largest room below it, so the way down takes the left child
   whenever it has enough.
2. Topping up: bins that are neither full nor at a power of two are the open
   ones. The emptiest give their pieces, cut to measure, to the fullest until at
   most one is left; only documents of such bins are cut.
3. The last open bin is cut into sequences of powers of two, which need no
   padding.

So a group needs no padding at all. Tokens are written once; the shuffle carries
only the rests, two bytes an id where the vocabulary allows. Nothing is counted
on the driver but the rests, for the number of groups.

A null text is empty: its document is the end id alone. Very long texts are many
full sequences. Repeated rows are documents each, null ids are kept, an empty
table gives no piece, further columns are ignored. Special tokens' strings in a
text become their ids, as the tokenizer does by default.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.llm.common import stored
from paddock.llm.encode import encoder

CAPACITY = 1024
GROUP_ROWS = 4096
_FLUSH = 8 << 20


def first_fit(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each size, in the given order: the first bin with room."""
    leaves = 1 << max(0, len(sizes) - 1).bit_length()
    room = [capacity] * (2 * leaves)
    bins = []
    for s in sizes:
        at = 1
        while at < leaves:
            at *= 2
            if room[at] < s:
                at += 1
        bins.append(at - leaves)
        room[at] -= s
        while at > 1:
            at >>= 1
            best = max(room[2 * at], room[2 * at + 1])
            if room[at] == best:
                break
            room[at] = best
    return bins


def _settled(size: int, capacity: int) -> bool:
    return size == capacity or size & (size - 1) == 0


def top_up(bins: list[list[tuple[int, int, int]]], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Bins of pieces (item, start, length) -> sequences that need no padding."""
    fill = [sum(p[2] for p in b) for b in bins]
    done = [b for b, n in zip(bins, fill, strict=True) if _settled(n, capacity)]
    left = sorted(((n, i) for i, n in enumerate(fill) if not _settled(n, capacity)), reverse=True)
    todo = [(list(bins[i]), n) for n, i in left]                  # the fullest first
    lo, hi = 0, len(todo) - 1
    while lo < hi:
        (pieces, n), (giver, m) = todo[lo], todo[hi]
        item, start, length = giver.pop()
        part = min(length, capacity - n)
        pieces.append((item, start + length - part, part))
        if part < length:
            giver.append((item, start, length - part))
        todo[lo], todo[hi] = (pieces, n + part), (giver, m - part)
        if n + part == capacity:
            lo += 1
        if _settled(m - part, capacity):       # 0, or a power of two: it stays as it is
            hi -= 1
    done += [b for b, n in todo if n and _settled(n, capacity)]
    for pieces, n in todo[lo:hi + 1]:
        if _settled(n, capacity):
            continue
        rest = pieces[::-1]
        for bit in range(n.bit_length() - 1, -1, -1):
            need, seq = n & (1 << bit), []
            while need:
                item, start, length = rest.pop()
                part = min(length, need)
                seq.append((item, start, part))
                if part < length:
                    rest.append((item, start + part, length - part))
                need -= part
            if seq:
                done.append(seq)
    return done


def pack_group(sizes: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (item, start, length); sizes from 1 to capacity, longest first."""
    bins: list[list[tuple[int, int, int]]] = []
    for i, (b, s) in enumerate(zip(first_fit(sizes, capacity), sizes, strict=True)):
        if b == len(bins):
            bins.append([])
        bins[b].append((i, 0, s))
    return top_up(bins, capacity)


def _encode(path: str, end_id: int, capacity: int, schema: pa.Schema):
    """Rows (row, doc_id, text) -> a row per full sequence and one of the rest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        width, end = enc.dtype.itemsize, np.array([end_id], enc.dtype).tobytes()
        number = TaskContext.get().partitionId() << 33
        for b in batches:
            texts, out, held = b.column(2), [], 0
            for i in range(b.num_rows):
                ids = enc.ids(texts[i].as_py() or "") + end
                n = len(ids) // width
                for start in range(0, n, capacity):
                    part = ids[start * width:(start + capacity) * width]
                    full = n - start >= capacity
                    out.append((i, n, start, number if full else None, part))
                    number += full
                    held += len(part)
                if held > _FLUSH:
                    yield _batch(b, out, schema)
                    out, held = [], 0
            if out:
                yield _batch(b, out, schema)
    return run


def _batch(b: pa.RecordBatch, out: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    at, n, start, number, ids = zip(*out, strict=True)
    at = pa.array(at, pa.int32())
    cols = [b.column(0).take(at), b.column(1).take(at), n, start, number, ids]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type)
                                       for c, f in zip(cols, schema, strict=True)], schema=schema)


def _packed(capacity: int, width: int):
    def run(t: pa.Table) -> pa.Table:
        raw = t.column("ids").to_pylist()
        rows = t.column("row").to_numpy()
        sizes = np.array([len(x) for x in raw]) // width
        order = np.lexsort((rows, -sizes))
        base = t.column("grp")[0].as_py() << 32
        at, start, length, seq, offset, ids = [], [], [], [], [], []
        for k, pieces in enumerate(pack_group(sizes[order].tolist(), capacity)):
            here = 0
            for item, s, n in pieces:
                i = order[item]
                at.append(i)
                start.append(s)
                length.append(n)
                seq.append(2 * (base + k) + 1)
                offset.append(here)
                ids.append(raw[i][s * width:(s + n) * width])
                here += n
        t = t.take(pa.array(at))
        begin = np.array(start) + t.column("start").to_numpy()
        return pa.table({"doc_id": t.column("doc_id"), "start": pa.array(begin, pa.int64()), "length": pa.array(length, pa.int64()),
                         "ids": pa.array(ids, pa.binary()), "doc_tokens": t.column("doc_tokens"),
                         "sequence_id": pa.array(seq, pa.int64()), "offset": pa.array(offset, pa.int64())})
    return run


def _wide(width: int):
    """Ids of ``width`` bytes as unsigned 32-bit ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                k = part.schema.get_field_index("ids")
                ids = [np.frombuffer(x, f"<u{width}").astype("<u4").tobytes() for x in part.column(k).to_pylist()]
                yield part.set_column(k, "ids", pa.array(ids, pa.binary()))
    return run


def pack(docs: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS,
         doc_id: str = "doc_id", text: str = "text", seed: int = 13) -> DataFrame:
    """doc_id, start, length, ids (unsigned 32-bit little-endian), doc_tokens,
    sequence_id, offset: a row per piece.

    ``path``: a tokenizer file that all executors have.
    """
    width = encoder(path).dtype.itemsize
    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"),
                      F.col(text).cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {kind}, doc_tokens long, start long, number long, ids binary"
    arrow = src.select("row", "doc_id").limit(0).toArrow().schema
    arrow = pa.schema([arrow.field(0), arrow.field(1), ("doc_tokens", pa.int64()), ("start", pa.int64()),
                       ("number", pa.int64()), ("ids", pa.binary())])
    runs = stored(src.mapInArrow(_encode(path, end_id, capacity, arrow), schema), "pack-ids")
    rests = runs.filter("number is null")
    groups = max(1, -(-rests.count() // group_rows))
    out = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    packed = (rests.withColumn("grp", F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(groups)))
                   .groupBy("grp").applyInArrow(_packed(capacity, width), out))
    full = (runs.filter("number is not null")
                .select("doc_id", "start", F.lit(capacity).cast("long").alias("length"), "ids", "doc_tokens",
                        (2 * F.col("number")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    both = full.unionByName(packed)
    return both if width == 4 else both.mapInArrow(_wide(width), out)


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, n_tokens, ids, pieces (offset, doc_id, start, length): a row
    per sequence, of at most ``capacity`` pieces each."""
    item = F.struct("offset", "doc_id", "start", "length", "ids")
    whole = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.array_sort(F.collect_list(item)).alias("all"))
    return whole.select("sequence_id", "n_tokens",
                        F.aggregate("all", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
                        F.transform("all", lambda x: F.struct(x["offset"].alias("offset"), x["doc_id"].alias("doc_id"),
                                                              x["start"].alias("start"), x["length"].alias("length"))).alias("pieces"))
