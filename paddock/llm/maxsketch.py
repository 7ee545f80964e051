"""Ranked lexical search over hashed max-sketches.

Index, one pass over the documents: a document's terms are hashed to the slots
of ``ROWS`` tables, and a slot keeps the largest frequency of its terms. A term's
impact (1e9 * tf) div (1000 * tf + 8 * m) grows with its frequency while m is the
document's own, so the slot's maximum is the maximum of the impacts, and the
least of a term's slots bounds its impact from above. Tables have ``SLOTS`` slots
or more for a distinct term, whatever the document's length. Frequencies of
``_MANY`` or more are kept as "any". Beside the sketch lie the document's terms
and frequencies, and the pass counts in how many documents each term occurs: by
task first, then over all.

Search, in blocks of items: a task looks all terms of the block up in a
document's sketch and sums weight times bound into upper bounds of all items'
scores. Of a batch, an item's documents are scored exactly in the order of their
bounds, until the next bound (ties: the next id) can't enter the item's best
``k`` so far: an exact stop. Each task returns the k best of its rows, and a
ranking keeps the k best of all.

Items are a stated query set. Their weights come from a join with the counted
terms; blocks of about ``BLOCK_TERMS`` terms are read and broadcast one after the
other and released, so the driver holds one block whatever their number.

Nulls: a null text has no term, such documents count nowhere; an item without a
term that occurs has no row. Null ids come after all others among equal scores.
Repeated documents are ranked each, repeated rows of one item id and text count
once; an id with several texts is ranked for each. Very long texts are counted
whole. Empty tables give no row, further columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paddock.llm.common import ascii_lower, stored

K = 10
ROWS, SLOTS = 2, 4
BLOCK_TERMS = 1 << 17
_MANY = 255
_TOP = 1_000_000            # no impact is above it
_HELD_TERMS = 300_000
_FLUSH = 8 << 20
#: Term characters: digits, ASCII letters and everything beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_INSIDE = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
INDEX = "doc_id long, n long, sketch binary, terms binary, tfs binary, term string, df long"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary()), ("terms", pa.binary()),
                    ("tfs", pa.binary()), ("term", pa.string()), ("df", pa.int64())])


def term_counts(text: bytes) -> Counter:
    """Terms of a text in UTF-8: a term never ends inside a character."""
    return Counter(text.translate(_INSIDE).split())


def _slots(crc: np.ndarray, bits: int) -> list[np.ndarray]:
    """The slots of hashed terms in each table."""
    mixed = crc
    out = []
    for _ in range(ROWS):
        out.append((mixed >> np.uint64(32 - bits)).astype(np.int64))
        mixed = mixed * np.uint64(0x9E3779B1) + np.uint64(0x7F4A7C15) & np.uint64(0xFFFFFFFF)
    return out


def _hashed(terms) -> np.ndarray:
    crc = np.fromiter(map(zlib.crc32, terms), np.uint64)
    return crc * np.uint64(0x85EBCA6B) & np.uint64(0xFFFFFFFF)


def sketch(counts: Counter) -> bytes:
    bits = max(5, (SLOTS * len(counts) - 1).bit_length())
    tf = np.minimum(np.fromiter(counts.values(), np.int64, len(counts)), _MANY).astype(np.uint8)
    table = np.zeros((ROWS, 1 << bits), np.uint8)
    for r, at in enumerate(_slots(_hashed(counts), bits)):
        np.maximum.at(table[r], at, tf)
    return table.tobytes()


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df: Counter = Counter()

    def out(rows, terms=()):
        cols = list(zip(*rows, strict=True)) if rows else [()] * 5
        n, t = len(rows), len(terms)
        return pa.RecordBatch.from_arrays(
            [pa.array([*c, *[None] * t], f.type) for c, f in zip(cols, _ARROW, strict=False)]
            + [pa.array([*[None] * n, *[k.decode() for k, _ in terms]], pa.string()),
               pa.array([*[None] * n, *[v for _, v in terms]], pa.int64())], schema=_ARROW)

    def flush():
        items = list(df.items())
        df.clear()
        for lo in range(0, len(items), 50_000):
            yield out([], items[lo:lo + 50_000])

    for b in batches:
        ids, texts = b.column(0).to_pylist(), b.column(1).cast(pa.binary())
        rows, held = [], 0
        for doc_id, text in zip(ids, texts, strict=True):
            counts = term_counts(text.as_py()) if text.is_valid else None
            if not counts:
                continue
            df.update(counts.keys())
            tf = np.fromiter(counts.values(), "<u4", len(counts))
            rows.append((doc_id, int(tf.sum()), sketch(counts), b" ".join(counts), tf.tobytes()))
            held += len(rows[-1][2]) + len(rows[-1][3])
            if held > _FLUSH:
                yield out(rows)
                rows, held = [], 0
        if rows:
            yield out(rows)
        if len(df) > _HELD_TERMS:
            yield from flush()
    yield from flush()


def index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The written index: a row per document with a term (``term`` null), and
    partial document counts of terms (``term`` and ``df``)."""
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return stored(src.mapInArrow(_build, INDEX), "sketch-index")


def weighted(idx: DataFrame, items: DataFrame, n_docs: int, item_id: str, text: str) -> DataFrame:
    """item, item_id, terms (term, weight): the items' terms that occur."""
    asked = items.select(F.col(item_id).alias("item_id"), F.col(text).cast("string").alias("text")).distinct()
    terms = stored(asked.select(F.monotonically_increasing_id().alias("item"), "item_id",
                                F.array_distinct(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(TERM), F.lit(0))).alias("all"))
                        .select("item", "item_id", F.explode("all").alias("term")), "search-terms")
    known = idx.filter("term is not null").select("term", "df").join(terms.select("term").distinct(), "term", "left_semi")
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2.0) / (2.0 * F.col("df") + 1.0))).cast("long")
    df = known.groupBy("term").agg(F.sum("df").alias("df")).select("term", weight.alias("weight"))
    return (terms.join(df, "term").groupBy("item", "item_id")
                 .agg(F.collect_list(F.struct("term", "weight")).alias("terms")))


class Block:
    """Items of a block: their terms as rows of a weight matrix over the block's vocabulary."""

    def __init__(self, rows):
        self.ids = [r["item"] for r in rows]
        self.terms = [[(t["term"].encode(), t["weight"]) for t in r["terms"]] for r in rows]
        place: dict[bytes, int] = {}
        at = [[place.setdefault(t, len(place)) for t, _ in ts] for ts in self.terms]
        self.starts = np.cumsum([0] + [len(a) for a in at])[:-1]
        self.at = np.array([i for a in at for i in a], np.int64)
        self.weight = np.array([w for ts in self.terms for _, w in ts], np.int64)
        self.hash = _hashed(place)
        self.slots: dict[int, list[np.ndarray]] = {}

    def bounds(self, raw: bytes, m: int) -> np.ndarray:
        """Upper bounds of the document's score for each item."""
        table = np.frombuffer(raw, np.uint8).reshape(ROWS, -1)
        bits = table.shape[1].bit_length() - 1
        if bits not in self.slots:
            self.slots[bits] = _slots(self.hash, bits)
        tf = np.minimum.reduce([t[s] for t, s in zip(table, self.slots[bits], strict=True)])
        levels = np.arange(_MANY + 1)
        impact = 1_000_000_000 * levels // (1000 * levels + 8 * m)
        impact[_MANY] = _TOP
        return np.add.reduceat(impact[tf][self.at] * self.weight, self.starts)


def exact(terms: list[tuple[bytes, int]], tfs: dict[bytes, int], m: int) -> int:
    total = 0
    for t, w in terms:
        tf = tfs.get(t)
        if tf:
            total += w * (1_000_000_000 * tf // (1000 * tf + 8 * m))
    return total


def _rank(doc_id) -> tuple[bool, int]:
    return doc_id is None, doc_id or 0


def search_batch(block: Block, docs: list[tuple], n_docs: int, n_terms: int, best: list[list], k: int) -> int:
    """Update the items' ``best`` (sorted (-score, null id, id)) by documents
    (id, n, sketch, terms, tfs); returns the number of exact scores."""
    m = [10 + 90 * d[1] * n_docs // n_terms for d in docs]
    upper = np.array([block.bounds(d[2], x) for d, x in zip(docs, m, strict=True)])
    low = np.array([-b[-1][0] if len(b) == k else 1 for b in best])
    opened: dict[int, dict[bytes, int]] = {}
    work = 0
    for j in np.flatnonzero((upper >= low).any(axis=0)):
        mine, bound = best[j], upper[:, j]
        some = np.flatnonzero(bound >= low[j])
        for i in some[np.argsort(-bound[some], kind="stable")].tolist():
            doc_id, _, _, terms, tfs = docs[i]
            if len(mine) == k and bound[i] < -mine[-1][0]:
                break
            if len(mine) == k and (-bound[i], *_rank(doc_id)) >= mine[-1]:
                continue
            if i not in opened:
                opened[i] = dict(zip(terms.split(b" "), np.frombuffer(tfs, "<u4").tolist(), strict=True))
            work += 1
            score = exact(block.terms[j], opened[i], m[i])
            key = (-score, *_rank(doc_id))
            if score > 0 and (len(mine) < k or key < mine[-1]):
                insort(mine, key)
                del mine[k:]
    return work


def _search(shared, n_docs: int, n_terms: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        best: list[list] = [[] for _ in block.ids]
        for b in batches:
            docs = list(zip(*[c.to_pylist() for c in b.columns], strict=True))
            search_batch(block, docs, n_docs, n_terms, best, k)
        found = [(i, None if null else d, -s) for i, top in zip(block.ids, best, strict=True) for s, null, d in top]
        item, doc_id, score = zip(*found, strict=True) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (item, doc_id, score)], ["item", "doc_id", "score"])
    return run


def search(docs: DataFrame, items: DataFrame, k: int = K, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k best documents."""
    spark = docs.sparkSession
    idx = index(docs, doc_id, text)
    rows = idx.filter("term is null")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("l")).first()
    asked = stored(weighted(idx, items, size["n"], item_id, item_text), "search-items")
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-total // block_terms)
    found = None
    for b in range(blocks):
        held = asked.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).select("item", "terms").collect()
        if not held:
            continue
        shared = spark.sparkContext.broadcast(Block(held))
        del held
        here = (rows.select("doc_id", "n", "sketch", "terms", "tfs")
                    .mapInArrow(_search(shared, size["n"], size["l"], k), "item long, doc_id long, score long"))
        here = stored(here, "search-found")
        shared.destroy()
        found = here if found is None else found.unionByName(here)
    if found is None:
        return asked.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"),
                            F.lit(0).cast("long").alias("score")).limit(0)
    w = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    top = found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return top.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
