"""Conversation prefix trie by padded turn-id matrices.

A conversation c is rebuilt from the first h turns of c - c % 100 and its own
turns after its first h, h = crc32(c) % 6. A node of the trie is a distinct
sequence of first d rebuilt turns.

1. Turns are ranged in dialogue order, so positions inside a conversation are
   local counts plus those of earlier ranges, a row per range and conversation.
2. Rebuilt turns get 128-bit ids hashed with their depth, and every ``width``
   turns of a conversation become one band: a row with the ids, the code points
   and, as its prefix, the XOR of all ids before it. A conversation of a third
   of all turns is many bands, and a prefix is the same for all that share it.
3. Bands are ranged by (band, prefix, ids, conversation) and taken in blocks. A
   block is a padded matrix of turn ids: numpy lexsorts it, an OR-accumulated
   change mask per column marks where nodes start, and reduceat sums each depth.
   Nodes that hold neither the first nor the last row of a block are complete.
   The others, and nodes that go on in the next band, are parts, which
   recombine by the XOR of their ids: at most two paths a block.
4. Sums over subtrees are sums over members. A conversation represents the nodes
   whose smallest member it is: from some depth down, or none. It adds a leaf if
   it represents a childless node, and the code points above the depth from which
   it represents, since there each of its turns repeats another's. So a first
   pass over the blocks finds what each conversation represents, a second sums.

The hash over a node's ended conversations is one stream by nature: blocks
render their ids, in order, and a node's chunks are hashed one after the other.

Turns go by turn (nulls first), then role, then text; null roles and texts are
empty. Rows without a conversation id take no part. Repeated rows are turns each.
An empty table has no node, further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paddock.llm.common import stored
from paddock.llm.components import salted_join
from paddock.session import shuffle_parts

HEADS, SPAN = 6, 100            # h < HEADS; heads come from each SPANth conversation
WIDTH = 16
BLOCK_ROWS = 32_768
_NOTHING = hashlib.sha256(b"").hexdigest()
_NODE = ("q binary, pq binary, depth long, conv_id long, parent long, n long, children long, leaves long, saved long, "
         "before long, whole boolean, edge boolean, sha string, ends binary, first_end long")


def _ranged(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """Rows in ranges of ``keys``, sorted by ``order`` inside."""
    return df.repartitionByRange(shuffle_parts(df.sparkSession), *keys).sortWithinPartitions(*order)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the range's number and the row's place in its conversation's run."""
    piece, last, seen = TaskContext.get().partitionId(), None, 0
    for b in batches:
        conv = b.column(0).to_numpy()
        if not len(conv):
            continue
        starts = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
        place = np.arange(len(conv)) - np.repeat(starts, np.diff(np.r_[starts, len(conv)]))
        if conv[0] == last:
            place[:starts[1] if len(starts) > 1 else len(conv)] += seen
        last, seen = conv[-1], place[-1] + 1
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(conv), piece, np.int32)), pa.array(place)],
                                         [*b.schema.names, "piece", "place"])


def rebuilt(chats: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, length, depth (from 1; 0 for a conversation without turns), a,
    b (the turn's hashes), size (code points of its text)."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    t = (chats.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), empty(role).alias("role"), empty(text).alias("text"))
              .filter("conv_id is not null"))
    order = ["conv_id", "turn", "role", "text"]
    t = _ranged(t, order, order).select("conv_id", F.xxhash64("role", "text").alias("a"),
                                        F.xxhash64(F.lit("b"), "role", "text").alias("b"), F.length("text").cast("long").alias("size"))
    t = stored(t.mapInArrow(_number, "conv_id long, a long, b long, size long, piece int, place long"), "trie-turns")
    every, earlier = Window.partitionBy("conv_id"), Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    runs = (t.groupBy("piece", "conv_id").agg(F.count(F.lit(1)).alias("n"))
             .withColumns({"own": F.sum("n").over(every), "earlier": F.coalesce(F.sum("n").over(earlier), F.lit(0)),
                           "h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS,
                           "base": F.col("conv_id") - F.col("conv_id") % SPAN}))
    runs = stored(runs, "trie-runs")
    bases = runs.filter("earlier = 0 and conv_id = base").select("base", F.col("own").alias("has"))
    lead = F.least(F.col("h"), F.coalesce("has", F.lit(0)))
    runs = (runs.join(bases, "base", "left").withColumn("lead", lead)
                .withColumn("length", F.col("lead") + F.greatest(F.col("own") - F.col("h"), F.lit(0))))
    mine = t.join(runs.select("piece", "conv_id", "earlier", "h", "lead", "length"), ["piece", "conv_id"]).withColumn("at", F.col("place") + F.col("earlier"))
    tails = mine.filter("at >= h").select("conv_id", "length", (F.col("at") - F.col("h") + F.col("lead") + 1).alias("depth"), "a", "b", "size")
    first = mine.filter(f"conv_id % {SPAN} = 0 and at < {HEADS}").select(F.col("conv_id").alias("base"), "at", "a", "b", "size")
    convs = runs.filter("earlier = 0").select("conv_id", "base", "h", "length")
    heads = convs.join(first, "base").filter("at < h").select("conv_id", "length", (F.col("at") + 1).alias("depth"), "a", "b", "size")
    zero = F.lit(0).cast("long")
    bare = convs.filter("length = 0").select("conv_id", "length", zero.alias("depth"), zero.alias("a"), zero.alias("b"), zero.alias("size"))
    return tails.unionByName(heads).unionByName(bare)


def _assemble(width: int):
    """Sorted turns -> bands, with XOR and size sums of the run's earlier bands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, rows, open_ = TaskContext.get().partitionId(), [], None

        def close(o):
            ids = np.array(o["ids"], ">u8").reshape(-1, 2)
            x = np.bitwise_xor.reduce(ids, axis=0) if len(ids) else np.zeros(2, np.uint64)
            chars = sum(o["sizes"])
            rows.append((piece, o["conv"], o["band"], o["length"], ids.tobytes(), np.array(o["sizes"], "<i8").tobytes(),
                         *o["x"].astype(np.uint64).view(np.int64).tolist(), *x.astype(np.uint64).view(np.int64).tolist(), o["s"], chars))
            return o["x"] ^ x.astype(np.uint64), o["s"] + chars

        names = ["piece", "conv_id", "band", "length", "ids", "sizes", "l1", "l2", "x1", "x2", "ls", "chars"]

        def out():
            cols = [pa.array(c, pa.binary() if n in ("ids", "sizes") else pa.int64()) for c, n in zip(zip(*rows, strict=True), names, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(cols, names)

        for b in batches:
            for conv, length, band, depth, a, c, size in zip(*[x.to_pylist() for x in b.columns], strict=True):
                if open_ is None or (open_["conv"], open_["band"]) != (conv, band):
                    x, s = close(open_) if open_ else (None, 0)
                    if open_ is None or open_["conv"] != conv:
                        x, s = np.zeros(2, np.uint64), 0
                    open_ = {"conv": conv, "band": band, "length": length, "ids": [], "sizes": [], "x": x, "s": s}
                if depth:
                    open_["ids"] += (a & 0xFFFFFFFFFFFFFFFF, c & 0xFFFFFFFFFFFFFFFF)
                    open_["sizes"].append(size)
                if len(rows) >= 10_000:
                    yield out()
        if open_:
            close(open_)
        if rows:
            yield out()
    return run


def bands(turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """conv_id, piece, band, length, ids, sizes, p1, p2 (XOR of all ids before),
    s (code points before), total (code points of the conversation)."""
    last = F.greatest(F.col("depth") - 1, F.lit(0))
    t = turns.select("conv_id", "length", F.floor(last / width).alias("band"), "depth",
                     F.xxhash64("depth", "a").alias("a"), F.xxhash64("depth", "b").alias("b"), "size")
    schema = ("piece long, conv_id long, band long, length long, ids binary, sizes binary, l1 long, l2 long, x1 long, x2 long, "
              "ls long, chars long")
    raw = stored(_ranged(t, ["conv_id", "band"], ["conv_id", "depth"]).mapInArrow(_assemble(width), schema), "trie-bands")
    every, earlier = Window.partitionBy("conv_id"), Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    runs = (raw.groupBy("piece", "conv_id").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"), F.sum("chars").alias("chars"))
               .select("piece", "conv_id", *[F.coalesce(f(c).over(earlier), zero).alias(o) for f, c, o in
                                             ((F.bit_xor, "x1", "o1"), (F.bit_xor, "x2", "o2"), (F.sum, "chars", "os"))],
                       F.sum("chars").over(every).alias("total")))
    return raw.join(runs, ["piece", "conv_id"]).select(
        "conv_id", "piece", "band", "length", "ids", "sizes", F.col("l1").bitwiseXOR(F.col("o1")).alias("p1"),
        F.col("l2").bitwiseXOR(F.col("o2")).alias("p2"), (F.col("ls") + F.col("os")).alias("s"), "total")


def _matrix(raw: list[bytes], kind: str, per: int, rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of packed values -> (how many, padded matrix rows x width x per)."""
    flat = np.frombuffer(b"".join(raw), kind).astype(kind[1:]).reshape(-1, per)
    k = np.array([len(x) for x in raw], np.int64) // (8 * per)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(k) - k, k)
    m = np.zeros((rows, width, per), flat.dtype)
    m[np.repeat(np.arange(rows), k), at] = flat
    return k, m


def block_nodes(conv, band, length, p1, p2, s, ids, sizes, leaf, amount, width: int, hashed: bool) -> pa.Table:
    """The nodes of one block of bands (columns of ``_NODE``)."""
    rows = len(conv)
    k, m = _matrix(ids, ">u8", 2, rows, width)
    _, chars = _matrix(sizes, "<i8", 1, rows, width)
    order = np.lexsort((conv, *[m[:, d, j] for d in range(width - 1, -1, -1) for j in (1, 0)], p2, p1, band))
    conv, band, length, p1, p2, s, leaf, amount, k = (x[order] for x in (conv, band, length, p1, p2, s, leaf, amount, k))
    m, chars = m[order], chars[order, :, 0]
    q = np.stack([p1, p2], 1).view(np.uint64)
    new = np.r_[True, (band[1:] != band[:-1]) | (q[1:] != q[:-1]).any(axis=1)]
    before = s.copy()                                   # code points above the node's last turn
    up = None                                           # per row: the column before's node: least conversation, known, key
    out = []
    for d in range(width + 1):
        if d:
            new[1:] |= (m[1:, d - 1] != m[:-1, d - 1]).any(axis=1)
            parent_q, q = q, q ^ m[:, d - 1]
            if d > 1:
                before = before + chars[:, d - 2]
        starts = np.flatnonzero(new)
        if d < width:
            child = new.copy()
            child[1:] |= (m[1:, d] != m[:-1, d]).any(axis=1)
            child &= k > d
        else:
            child = np.zeros(rows, bool)
        stops = np.r_[starts[1:], rows]
        edge = (starts == 0) | (stops == rows)
        goes_on = np.logical_or.reduceat(length > (band + 1) * width, starts) if d == width else np.zeros(len(starts), bool)
        here = np.flatnonzero((k[starts] >= d) & ((d > 0) | (band[starts] >= 0)))
        at = starts[here]
        n = stops - starts
        least = np.minimum.reduceat(conv, starts)
        inner = child.copy()                            # children that hold the block's first or last row count later
        if rows and child.any():
            heads = np.flatnonzero(child)
            tail_new = np.flatnonzero(new | child)
            last = heads[-1] if k[-1] > d and heads[-1] == tail_new[-1] else None
            if last is not None:
                inner[last] = False
            if child[0]:
                inner[0] = False
        children = np.add.reduceat(inner.astype(np.int64), starts)
        base = before if d else np.zeros(rows, np.int64)
        saved = np.add.reduceat(np.maximum(amount - base, 0), starts)
        leaves = np.add.reduceat(leaf, starts)
        upper = (d == 0) & (band[starts] > 0)           # a node of the band before: only its children are known here
        whole = ~(edge | goes_on) & (d > 0)
        ended = (k == d) & (length == band * width + d)
        sha, ends, first = np.full(len(starts), _NOTHING, object), np.full(len(starts), None, object), np.full(len(starts), None, object)
        if hashed and ended.any():
            e = np.flatnonzero(ended)
            group = np.searchsorted(starts, e, side="right") - 1
            cut = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            for g, lo, hi in zip(group[cut], cut, np.r_[cut[1:], len(e)], strict=True):
                text = ",".join(map(str, conv[e[lo:hi]].tolist())).encode()
                if whole[g]:
                    sha[g] = hashlib.sha256(text).hexdigest()
                else:
                    ends[g], first[g] = text, int(conv[e[lo]])
        key = lambda x: pa.array([v.tobytes() for v in x.astype(">u8")], pa.binary())
        null = upper[here]
        known = up[1][at] if d else np.zeros(len(at), bool)
        out.append(pa.table({
            "q": key(q[at]), "pq": key(parent_q[at]) if d else pa.nulls(len(at), pa.binary()),
            "depth": pa.array(band[at] * width + d), "conv_id": pa.array(least[here], mask=null),
            "parent": pa.array(up[0][at] if d else np.zeros(len(at), np.int64), mask=~known),
            "n": pa.array(np.where(null, 0, n[here])), "children": pa.array(children[here]),
            "leaves": pa.array(np.where(null, 0, leaves[here])), "saved": pa.array(np.where(null, 0, saved[here])),
            "before": pa.array(base[at], mask=null), "whole": pa.array(whole[here]),
            "edge": pa.array(edge[here] & ~null), "sha": pa.array(np.where(whole[here], sha[here], None), pa.string()),
            "ends": pa.array(ends[here].tolist(), pa.binary()), "first_end": pa.array(first[here].tolist(), pa.int64())}))
        up = np.repeat(least, n), np.repeat(~edge & (d > 0), n)
    return pa.concat_tables(out)


def _blocks(width: int, block_rows: int, hashed: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held):
            t = pa.Table.from_batches(held)
            num = {c: t.column(c).to_numpy() for c in ("conv_id", "band", "length", "p1", "p2", "s", "leaf", "amount")}
            nodes = block_nodes(num["conv_id"], num["band"], num["length"], num["p1"], num["p2"], num["s"],
                                t.column("ids").to_pylist(), t.column("sizes").to_pylist(), num["leaf"], num["amount"], width, hashed)
            yield from nodes.combine_chunks().to_batches(max_chunksize=10_000)

        held, rows = [], 0
        for b in batches:
            held.append(b)
            rows += b.num_rows
            if rows >= block_rows:
                yield from out(held)
                held, rows = [], 0
        if rows:
            yield from out(held)
    return run


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(q, ends) in order -> (q, sha): one running hash per node."""
    last, h, keys, shas, going = None, None, [], [], False
    for b in batches:
        for q, ends in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if q != last:
                if last is not None:
                    keys.append(last)
                    shas.append(h.hexdigest())
                last, h, going = q, hashlib.sha256(), False
            if going:
                h.update(b",")
            h.update(ends)
            going = True
    if last is not None:
        keys.append(last)
        shas.append(h.hexdigest())
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(shas, pa.string())], ["q", "sha"])


def _nodes(b: DataFrame, width: int, block_rows: int, hashed: bool) -> tuple[DataFrame, DataFrame]:
    """The nodes that blocks complete, and the recombined ones."""
    order = ["band", "p1", "p2", "ids", "conv_id"]
    cols = ["conv_id", "band", "length", "p1", "p2", "s", "ids", "sizes", "leaf", "amount"]
    found = stored(_ranged(b.select(cols), order, order).mapInArrow(_blocks(width, block_rows, hashed), _NODE), "trie-nodes")
    parts = found.filter("not whole")
    one = (parts.groupBy("q").agg(F.max("pq").alias("pq"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
                                  F.max("parent").alias("parent"), F.sum("n").alias("n"), F.sum("children").alias("children"),
                                  F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("before").alias("before"),
                                  F.max("edge").alias("edge")))
    one = stored(one, "trie-parts")
    more = one.filter("edge and pq is not null").groupBy(F.col("pq").alias("q")).agg(F.count(F.lit(1)).alias("more"))
    one = one.join(more, "q", "left").withColumn("children", F.col("children") + F.coalesce("more", F.lit(0))).drop("more")
    if hashed:
        sha = (parts.filter("ends is not null").select("q", "ends", "first_end").repartition(shuffle_parts(b.sparkSession), "q")
                    .sortWithinPartitions("q", "first_end").select("q", "ends").mapInArrow(_digest, "q binary, sha string"))
        one = one.join(sha, "q", "left").withColumn("sha", F.coalesce("sha", F.lit(_NOTHING)))
    return found.filter("whole"), one


def trie(chats: DataFrame, width: int = WIDTH, block_rows: int = BLOCK_ROWS, **columns) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256: a row per node."""
    b = stored(bands(rebuilt(chats, **columns), width), "trie-rows")
    zero = F.lit(0).cast("long")
    whole, one = _nodes(b.withColumns({"leaf": zero, "amount": zero}), width, block_rows, False)
    kept = ["conv_id", "depth", "before", "children"]
    stands = (whole.select(kept).unionByName(one.select(kept)).groupBy("conv_id")
                   .agg(F.min_by("before", "depth").alias("repeats"), F.max((F.col("children") == 0).cast("long")).alias("leaf")))
    runs = b.select("piece", "conv_id", "total").distinct().join(stands, "conv_id", "left").select(
        "piece", "conv_id", F.coalesce("repeats", "total").alias("amount"), F.coalesce("leaf", zero).alias("leaf"))
    whole, one = _nodes(b.join(runs, ["piece", "conv_id"]), width, block_rows, True)
    one = stored(one, "trie-joined")
    cols = ["q", "pq", "depth", "conv_id", "parent", "n", "children", "leaves", "saved", "sha"]
    every = whole.select(cols).unionByName(one.select(cols))
    above = one.select(F.col("q").alias("pq"), F.col("conv_id").alias("found"))
    asked = salted_join(every.filter("depth > 0 and parent is null"), above, "pq", "q")
    known = every.filter("depth = 0 or parent is not null").withColumn("found", F.col("parent"))
    both = asked.select(*cols, "found").unionByName(known.select(*cols, "found"))
    return both.select("conv_id", "depth", F.col("found").alias("parent_conv_id"), F.col("n").alias("n_convs"),
                       F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
                       F.col("saved").alias("saved_tokens"), F.col("sha").alias("ends_sha256"))
