"""Benchmark passages in documents, by pigeonhole pieces and Myers verification.

Item and document texts are lower-cased and their white space becomes single
spaces. An item of n characters may be off by k = floor(rate * n) edits. It is
split into k + 1 pieces: a passage within k edits holds one of them unchanged.
One automaton over the pieces of a block of items finds all exact hits in a
document; hits of an item that point to the same place give one window, in
which Myers' bit-parallel algorithm finds the least edit distance.

The stated query set, the benchmark, is taken in blocks of
about ``BLOCK_CHARS`` characters by a hash of the text, one pass over
the documents each, so what a task holds is bounded however many items there
are. Documents are never shuffled.

Items of fewer than ``MIN_CHARS`` normalised characters are held only where the
passage does not begin or end inside a word, a run of digits and cased letters
(scripts without case need not part their words, so they have no such bound);
their candidate passages are few and are compared one by one.

Nulls and ties: null texts match nothing and are no items, nor are texts of
white space alone. Items
of equal text are reported each, repeated item rows once. Of the places of an
item in a document the one with the least distance, then the first, is
reported. Rows that repeat a document id are rows each.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RATE = 0.08
MIN_CHARS = 32
BLOCK_CHARS = 4 << 20


def normal(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def myers(pattern: str, text: str) -> tuple[int, int]:
    """(least distance of the pattern to a substring of the text, the end of
    the first such substring)."""
    m = len(pattern)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << m - 1
    pv, mv, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = ((eq & pv) + pv ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & full
        pv = mh << 1 & full | ~(xv | ph) & full
        mv = ph & xv
        if score < best:
            best, end = score, j
    return best, end


def distance(a: str, b: str) -> int:
    """Edit distance of two short texts."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(left + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def _in_word(c: str) -> bool:
    return c.isdigit() or c.lower() != c.upper()


def border(text: str, at: int) -> bool:
    """Whether the place lies at no word's inside."""
    return not (0 < at < len(text) and _in_word(text[at - 1]) and _in_word(text[at]))


def whole_words(item: str, text: str, a: int, b: int, budget: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the first of the nearest passages between word
    borders of ``text[a:b]`` within the budget."""
    best, n = None, len(item)
    for i in range(a, b):
        if border(text, i):
            for j in range(max(i + 1, i + n - budget), min(b, i + n + budget) + 1):
                if border(text, j):
                    part = text[i:j]
                    d = 0 if part == item else distance(item, part) if budget else 1
                    if d <= budget and (best is None or d < best[0]):
                        best = (d, i, j)
    return best


class Finder:
    """Pieces of a block of items; those under ``min_chars`` stand between word borders."""

    def __init__(self, items: list[str], rate: float, min_chars: int = MIN_CHARS):
        self.items = items
        self.min_chars = min_chars
        self.budget = [int(rate * len(t)) for t in items]
        self.places: dict[str, list[tuple[int, int]]] = {}
        for i, (t, k) in enumerate(zip(items, self.budget, strict=True)):
            cuts = [len(t) * j // (k + 1) for j in range(k + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                self.places.setdefault(t[a:b], []).append((i, a))
        self.automaton = ahocorasick.Automaton()
        for p in self.places:
            self.automaton.add_word(p, p)
        self.automaton.make_automaton()

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """Item -> disjoint stretches of the text that may hold it."""
        found: dict[int, list[list[int]]] = {}
        if not self.places:
            return found
        for last, p in self.automaton.iter(text):
            for i, offset in self.places[p]:
                k = self.budget[i]
                begin = last + 1 - len(p) - offset
                found.setdefault(i, []).append([max(0, begin - k), min(len(text), begin + len(self.items[i]) + k)])
        for i, spans in found.items():
            spans.sort()
            out = [spans[0]]
            for a, b in spans[1:]:
                if a <= out[-1][1]:
                    out[-1][1] = max(out[-1][1], b)
                else:
                    out.append([a, b])
            found[i] = out
        return found

    def matches(self, text: str | None) -> Iterator[tuple[int, int, int, int]]:
        """(item, distance, start, end) of the best place of each item found."""
        t = normal(text)
        for i, spans in sorted(self.windows(t).items()):
            item, best = self.items[i], None
            if len(item) < self.min_chars:
                near = [x for a, b in spans if (x := whole_words(item, t, a, b, self.budget[i]))]
                if near:
                    yield i, *min(near)
                continue
            for a, b in spans:
                d, end = myers(item, t[a:b])
                if d <= self.budget[i] and (best is None or d < best[0]):
                    best = (d, a, a + end)
            if best:
                d, a, end = best
                back = myers(item[::-1], t[a:end][::-1])      # the start, from the end backwards
                yield i, d, end - back[1], end


def find(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
         item_text: str = "text", rate: float = RATE, min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, distance, start, end (in the normalised document text):
    a row for each item that a document holds within the item's edit budget."""
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("_text"))
    out = None
    for items in _blocks(benchmark, item_id, item_text, block_chars):
        got = source.mapInArrow(_matcher(docs.sparkSession.sparkContext.broadcast(items), rate, min_chars),
                                "doc_id long, item_id long, distance int, start int, end int")
        out = got if out is None else out.unionByName(got)
    return out


def _blocks(benchmark: DataFrame, item_id: str, item_text: str, block_chars: int):
    """Lists of (normalised text, its item ids), about ``block_chars`` of text each."""
    items = (benchmark.select(F.col(item_id).cast("long").alias("item"), F.col(item_text).cast("string").alias("body"))
             .filter("body is not null").distinct())
    size = items.agg(F.sum(F.length("body"))).first()[0] or 0
    blocks = max(1, -(-int(size) // block_chars))
    for block in range(blocks):
        by: dict[str, list] = {}
        for r in items.filter(F.pmod(F.xxhash64("body"), F.lit(blocks)) == block).collect():
            t = normal(r["body"])
            if t:
                by.setdefault(t, []).append(r["item"])
        yield [(t, sorted(set(x), key=lambda v: (v is None, v))) for t, x in sorted(by.items())]


def _matcher(shared, rate: float, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder([t for t, _ in shared.value], rate, min_chars)
        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                for item, d, start, end in finder.matches(t.as_py()):
                    rows += [(i, n, d, start, end) for n in shared.value[item][1]]
            if rows:
                cols = zip(*rows, strict=True)
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                                 ["doc_id", "item_id", "distance", "start", "end"])
    return run


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
          rate: float = RATE, min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item. Each row is judged in
    its own task, so rows without an id or with a repeated one are judged too."""
    out = docs
    for items in _blocks(benchmark, item_id, item_text, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast([t for t, _ in items])
        out = out.mapInArrow(_filter(shared, rate, min_chars, docs.columns.index(text)), docs.schema)
    return out


def _filter(shared, rate: float, min_chars: int, column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(shared.value, rate, min_chars)
        for b in batches:
            keep = [next(finder.matches(t.as_py()), None) is None for t in b.column(column)]
            yield b.filter(pa.array(keep, pa.bool_()))
    return run
