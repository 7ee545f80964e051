"""Log-bilinear language model trained with noise-contrastive estimation (numpy).

Tokens: ASCII-lower-cased words (runs of characters other than 0x20 and
0x09-0x0D), then one end token per text. A null text is an empty one. Repeated
rows are texts each; an empty table gives no rows; further columns, of any name,
are not read. A word of more than ``LONG`` bytes travels as its 16-byte digest.

Texts are split by Arrow, up to ``_BYTES`` at a time; Python looks up each distinct
word of these once.

Counts. Each task counts its words and flushes partial counts; one shuffle
adds them over all training texts and the table is written to shared storage.

Vocabulary. It grows with the corpus: of v distinct training words the
``ROOT`` * sqrt(v) most frequent have embeddings of their own. Every other word
belongs to one of ``TAILS`` tail tokens by its last three bytes, which have
embeddings too, so contexts and targets of rare words differ.

Model, two levels. The vocabulary, in order of frequency, is cut into about
sqrt(V) classes of similar mass (of root counts). The two tokens before the target
give a predicted embedding h = C1 r(w1) + C2 r(w2); its products with the class
embeddings score the class, those with the embeddings of the class's members score
the token. P(token) = P(class | h) P(token | class, h): a normaliser costs about
2 sqrt(V) products, not V. Both levels train by NCE: noise classes from the class
unigram, shared by a batch, and noise tokens of the target's own class, which are
other targets of the batch. A warm
start on ``WARM_TOKENS`` tokens, in epochs over the rows of smallest hash, then every
task trains on all its training texts from there and the parameters are
averaged, weighted by tokens, in slices (one round of parameter mixing).

Scoring. Batched matrix products give exact normalisers of both levels for each
distinct context of a batch. A word of tail token t gets P(t | context)
* (c + 1) / (N_t + V_t + 1), with its training count c and its tail's counts; the
one beyond stands for all unseen words of that tail.

Counts of words are looked up in two ways: the vocabulary and at least the ``HEAD``
most frequent words are broadcast (a bound on their number; keys are bounded in
bytes), the rest of each text's words go through a join on the word. A word of the
rest holds less than one part in ``HEAD`` of all tokens, so that join has no hot key.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.llm.common import stored

ROOT = 16
TAILS = 256
LONG = 48
HEAD = 1 << 17
DIM = 24
NOISE = 16                        # noise classes of a batch
INNER = 2                         # noise tokens of a target, of its class
BATCH = 2048
RATE = 0.2
WARM_DOCS = 2000
WARM_TOKENS = 1_500_000
_FLUSH = 400_000
_CHUNK = 1 << 18
_BYTES = 4 << 20
_SLICE = 1 << 16
END = None                        # the end token's key among the words


def _keys(words: list[bytes]) -> list[bytes]:
    """A long word's digest follows a space, which no word holds."""
    if words and max(map(len, words)) > LONG:
        words = [w if len(w) <= LONG else b" " + hashlib.blake2b(w, digest_size=16).digest() for w in words]
    return words


def _words(text: bytes | None) -> list[bytes]:
    """bytes.lower and bytes.split treat exactly A-Z and 0x20, 0x09-0x0D."""
    return _keys(text.lower().split() if text else [])


def _split(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """``_words`` of many texts at once: the place among the distinct words of every
    word, the distinct words, and where each text's words begin (at last, their number).
    Arrow's ASCII functions treat the same bytes and leave an empty word beside white
    space at a text's ends."""
    texts = pc.fill_null(pc.cast(texts, pa.string(), safe=False), "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    begin = np.asarray(lists.offsets, np.int64)
    begin = begin - begin[0]
    coded = lists.flatten().dictionary_encode()
    at, words = np.asarray(coded.indices), pc.cast(coded.dictionary, pa.binary())
    size = np.asarray(pc.binary_length(words))
    empty = np.flatnonzero(size == 0)
    if len(empty):
        kept = at != empty[0]
        begin = np.append(0, np.cumsum(kept))[begin]
        at = at[kept]
    if size.max(initial=0) > LONG:
        words = pa.array(_keys(_list(words)), pa.binary())
    return at, words, begin


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``_BYTES`` of text in the first column, or of one row."""
    for b in batches:
        end = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(b.column(0)), 0), np.int64))
        lo = 0
        while lo < b.num_rows:
            hi = max(int(np.searchsorted(end, (end[lo - 1] if lo else 0) + _BYTES, side="right")), lo + 1)
            yield b.slice(lo, hi - lo)
            lo = hi


def _list(words: pa.Array) -> list[bytes]:
    return words.to_numpy(zero_copy_only=False).tolist()


def _tail(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % TAILS


def word_counts(texts: DataFrame) -> DataFrame:
    """(word binary, c long) over all rows of a one-column frame of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, size = [], 0

        def merged() -> pa.Table:
            return pa.concat_tables(seen).group_by("word", use_threads=False).aggregate([("c", "sum")]).select(["word", "c_sum"]).rename_columns(["word", "c"])

        for b in _slices(batches):
            at, words, _ = _split(b.column(0))
            c = np.bincount(at, minlength=len(words))
            seen.append(pa.table({"word": words, "c": c}).filter(pa.array(c > 0)))
            size += seen[-1].num_rows
            if size > _FLUSH:
                seen = [merged()]
                if 2 * seen[0].num_rows > _FLUSH:
                    yield from seen[0].to_batches()
                    seen = []
                size = sum(t.num_rows for t in seen)
        if seen:
            yield from merged().to_batches()

    text = F.col(texts.columns[0]).cast("string").cast("binary")
    return texts.select(text).mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Counts:
    table: DataFrame              # (word, c), stored
    n: int                        # tokens, ends included
    v: int                        # distinct tokens, the end included
    ends: int
    head: dict[bytes, int]        # the most frequent words, those of the vocabulary first
    vocab: int                    # how many of them are the vocabulary
    tails: np.ndarray             # (2, TAILS): counts and distinct words outside the vocabulary


def count(texts: DataFrame, head: int = HEAD, vocab: int | None = None) -> Counts:
    """Word counts of all ``texts`` and the vocabulary, by default of
    ``ROOT`` * sqrt(distinct words). Equal counts go by the word's bytes."""
    table = stored(word_counts(texts), "lbl-counts")
    size = table.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = texts.count()
    vocab = math.ceil(ROOT * math.sqrt(size["v"])) if vocab is None else vocab
    head = max(head, vocab)
    bucket = F.floor(F.log2(F.col("c").cast("double")) * 16)
    least, n = 0, 0                                       # the bucket in which the head ends
    for r in table.groupBy(bucket.alias("k")).count().orderBy(F.desc("k")).collect():
        least, n = r["k"], n + r["count"]
        if n >= head:
            break
    rows = table.filter(bucket >= least).orderBy(F.desc("c"), "word").limit(head).collect()
    words = {bytes(r["word"]): r["c"] for r in rows}
    vocab = min(vocab, len(words))
    last = F.when(F.length("word") > 3, F.expr("substring(word, -3, 3)")).otherwise(F.col("word"))
    tails = np.zeros((2, TAILS), np.int64)
    for r in table.groupBy((F.crc32(last) % TAILS).alias("k")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        tails[:, r["k"]] = r["n"], r["v"]
    for w in list(words)[:vocab]:
        tails[:, _tail(w)] -= words[w], 1
    return Counts(table, size["n"] + ends, size["v"] + (ends > 0), ends, words, vocab, tails)


@dataclass
class Model:
    vocab: dict[bytes | None, int]  # word -> id; the end token's key is END
    tail: np.ndarray              # tail -> id
    cls: np.ndarray               # id -> class; a class's ids are contiguous
    lo: np.ndarray                # class -> its first id, and the number of ids at last
    log_class: np.ndarray         # log unigram of the classes
    log_inner: np.ndarray         # log unigram of the ids in their class
    params: list[np.ndarray]      # context, token and class embeddings, C1, C2, biases of tokens and classes


def new_model(c: Counts, dim: int = DIM) -> Model:
    keys = [END, *range(TAILS), *list(c.head)[:c.vocab]]
    n = np.array([c.ends, *c.tails[0], *[c.head[w] for w in keys[1 + TAILS:]]], float) + 1
    order = np.argsort(-n, kind="stable")
    n = n[order]
    place = np.empty(len(n), np.int64)
    place[order] = np.arange(len(n))
    mass = np.cumsum(np.sqrt(n))
    classes = math.ceil(math.sqrt(len(n)))
    _, cls = np.unique(np.minimum((mass / mass[-1] * classes).astype(int), classes - 1), return_inverse=True)
    lo = np.append(np.flatnonzero(np.diff(cls, prepend=-1)), len(n))
    whole = np.add.reduceat(n, lo[:-1])
    log_class, log_inner = np.log(whole / whole.sum()), np.log(n / whole[cls])
    rng = np.random.default_rng(17)
    some = lambda k: rng.normal(0, 0.1, (k, dim)).astype(np.float32)
    return Model({k: int(place[i]) for i, k in enumerate(keys) if not isinstance(k, int)}, place[1:1 + TAILS], cls, lo, log_class, log_inner, [
        some(len(n)), some(len(n)), some(len(whole)), np.eye(dim, dtype=np.float32), np.eye(dim, dtype=np.float32) * np.float32(0.5),
        log_inner.astype(np.float32), log_class.astype(np.float32)])


def _order(ids: np.ndarray, n: int) -> np.ndarray:
    """Stable order of ids below ``n``; 16-bit keys sort in linear time."""
    return np.argsort(ids.astype(np.uint16) if n <= 1 << 16 else ids, kind="stable")


def _starts(s: np.ndarray) -> np.ndarray:
    """Where the runs of a sorted array begin."""
    return np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))


def _sums(x: np.ndarray, begin: np.ndarray, order: np.ndarray | None = None) -> np.ndarray:
    """``np.add.reduceat`` over the rows of ``x`` (taken in ``order``). That costs a loop per
    run and column, so runs of one and of two rows, which are most, are added at once."""
    row = (lambda i: x.take(i, 0)) if order is None else (lambda i: x.take(order[i], 0))
    sizes = np.diff(np.append(begin, len(x)))
    out = row(begin)
    two = np.flatnonzero(sizes == 2)
    out[two] += row(begin[two] + 1)
    more = np.flatnonzero(sizes > 2)
    if len(more):
        k = sizes[more]
        at = np.cumsum(k) - k
        out[more] = np.add.reduceat(row(np.repeat(begin[more] - at, k) + np.arange(k.sum())), at, axis=0)
    return out


def _records(a: np.ndarray) -> np.ndarray:
    """The rows of a contiguous array as single items, which numpy sets faster."""
    return a.view(np.dtype((np.void, a.strides[0]))).reshape(-1) if a.ndim == 2 else a


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.minimum(np.maximum(x, -30, out=x), 30, out=x)
    np.exp(np.negative(x, out=x), out=x)
    x += 1
    return np.divide(1, x, out=x)


class Trainer:
    """Adagrad on the NCE objective of both levels; only rows in use change."""

    def __init__(self, model: Model, seed: int):
        self.m = model
        self.p = [x.copy() for x in model.params]
        self.g = [np.full_like(x, 1) for x in model.params]
        self.cdf = np.cumsum(np.exp(model.log_class))
        self.class_noise = (model.log_class + math.log(NOISE)).astype(np.float32)
        self.inner_noise = (model.log_inner + math.log(INNER)).astype(np.float32)
        self.rng = np.random.default_rng(seed)
        self.tokens = 0

    def _adagrad(self, i: int, g: np.ndarray, rows: np.ndarray | None = None) -> None:
        acc = g * g
        acc += self.g[i] if rows is None else self.g[i].take(rows, 0)
        if rows is None:
            self.g[i][:] = acc
        else:
            _records(self.g[i])[rows] = _records(acc)
        g *= np.float32(RATE)
        g /= np.sqrt(acc, out=acc)
        if rows is None:
            self.p[i] -= g
        else:
            _records(self.p[i])[rows] = _records(self.p[i].take(rows, 0) - g)

    def step(self, w2: np.ndarray, w1: np.ndarray, w: np.ndarray) -> None:
        """One batch, in the order of ``w``, hence of its classes."""
        ctx, out, tops, c1, c2, bias, top_bias = self.p
        m, n = self.m, len(w)
        r1, r2 = ctx.take(w1, 0), ctx.take(w2, 0)
        h = r1 @ c1
        h += r2 @ c2

        # the class, against noise classes that the batch shares
        k = m.cls[w]
        runs = _starts(k)
        neg = np.minimum(np.searchsorted(self.cdf, self.rng.random(NOISE) * self.cdf[-1]), len(self.cdf) - 1)
        shift = top_bias - self.class_noise
        q, qn = tops.take(k, 0), tops[neg]
        d_pos = -_sigmoid(-(np.einsum("ij,ij->i", h, q) + shift[k]))                    # d loss / d score
        d_neg = _sigmoid(h @ qn.T + shift[neg])
        dh = d_pos[:, None] * q + d_neg @ qn
        g_tops, g_top_bias = np.zeros_like(tops), np.zeros_like(top_bias)
        g_tops[k[runs]] = np.add.reduceat(d_pos[:, None] * h, runs, axis=0)
        g_top_bias[k[runs]] = np.add.reduceat(d_pos, runs)
        np.add.at(g_tops, neg, d_neg.T @ h)
        np.add.at(g_top_bias, neg, d_neg.sum(axis=0))

        # the token, against tokens that stand elsewhere in the batch, of its class: a draw from the class unigram
        e, shift = out.take(w, 0), bias[w] - self.inner_noise[w]
        d = -_sigmoid(-(np.einsum("ij,ij->i", h, e) + shift))
        dh += d[:, None] * e
        g_rows, g_bias = d[:, None] * h, d.copy()
        sizes = np.diff(np.append(runs, n))
        lo, size = np.repeat(runs, sizes), np.repeat(sizes, sizes)
        at = np.arange(n) - lo
        for _ in range(INNER):
            turn = np.repeat(self.rng.integers(0, sizes), sizes)
            other, back = at + turn, at - turn                                          # a rotation of each class
            other -= np.where(other >= size, size, 0)
            back += np.where(back < 0, size, 0)
            other += lo
            back += lo
            x = e.take(other, 0)
            d = _sigmoid(np.einsum("ij,ij->i", h, x) + shift[other])
            x *= d[:, None]
            dh += x
            g_rows += (d[:, None] * h).take(back, 0)
            g_bias += d[back]
        first = _starts(w)
        rows = w[first]

        both = np.concatenate((w1, w2))
        order = _order(both, len(ctx))
        used = both[order]
        begin = _starts(used)
        self._adagrad(0, _sums(np.concatenate((dh @ c1.T, dh @ c2.T)), begin, order), used[begin])
        self._adagrad(1, _sums(g_rows, first), rows)
        self._adagrad(2, g_tops)
        self._adagrad(3, (r1.T @ dh) / np.float32(n))
        self._adagrad(4, (r2.T @ dh) / np.float32(n))
        self._adagrad(5, np.add.reduceat(g_bias, first), rows)
        self._adagrad(6, g_top_bias)
        self.tokens += n

    def text_ids(self, ids: np.ndarray, starts: np.ndarray) -> None:
        w2, w1 = contexts(ids, starts, self.m.vocab[END])
        order = self.rng.permutation(len(ids))
        for lo in range(0, len(ids), BATCH):
            x = order[lo:lo + BATCH]
            x = x[_order(ids[x], len(self.m.cls))]
            self.step(w2[x], w1[x], ids[x])


def contexts(ids: np.ndarray, starts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The two tokens before each one; before a text's start stand ends."""
    w1 = np.concatenate(([end], ids[:-1]))
    w1[starts] = end
    w2 = np.concatenate(([end], w1[:-1]))
    w2[starts] = end
    return w2, w1


class _Numbers(dict):
    """Ids of words; a word without one has -1 - its tail."""

    def __missing__(self, word: bytes) -> int:
        return -1 - zlib.crc32(word[-3:]) % TAILS


def _encoded(batches: Iterator[pa.RecordBatch], number: _Numbers, rest: bool = False) -> Iterator:
    """(record batches, ids, starts, words without a number) in chunks of about
    _CHUNK tokens of whole texts; the words only if ``rest``, one list of (word, tf) a
    text, as arrays to concatenate."""
    get, end = number.__getitem__, number[END]
    parts, ids, starts, unknown, at = [], [], [], [], 0
    for b in _slices(batches):
        place, words, begin = _split(b.column(0))
        known = np.fromiter(map(get, _list(words)), np.int64, len(words))
        more = _unknown(place, words, begin, known < 0) if rest else None
        n = np.diff(begin)
        begin = begin + np.arange(len(begin))                    # an end follows each text's words
        x = np.full(begin[-1], end, np.int64)
        x[np.arange(len(place)) + np.repeat(np.arange(len(n)), n)] = known[place]
        lo = 0
        while lo < b.num_rows:
            hi = min(int(np.searchsorted(begin, begin[lo] + _CHUNK - at)), b.num_rows)
            parts.append(b.slice(lo, hi - lo))
            ids.append(x[begin[lo]:begin[hi]])
            starts.append(begin[lo:hi] - begin[lo] + at)
            if rest:
                unknown.append(more.slice(lo, hi - lo))
            at += len(ids[-1])
            lo = hi
            if at >= _CHUNK:
                yield parts, np.concatenate(ids), np.concatenate(starts), unknown
                parts, ids, starts, unknown, at = [], [], [], [], 0
    if ids:
        yield parts, np.concatenate(ids), np.concatenate(starts), unknown


def _unknown(place: np.ndarray, words: pa.Array, begin: np.ndarray, missing: np.ndarray) -> pa.ListArray:
    """(word, tf) of each text's distinct ``missing`` words."""
    text = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    there = missing[place]
    key, tf = np.unique(text[there] * len(words) + place[there], return_counts=True)
    cut = np.searchsorted(key, np.arange(len(begin)) * len(words))
    return pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.StructArray.from_arrays(
        [words.take(pa.array(key % max(len(words), 1))), pa.array(tf, pa.int32())], ["word", "tf"]))


def _pack(params: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([p.ravel() for p in params])


def _unpack(flat: np.ndarray, like: list[np.ndarray]) -> list[np.ndarray]:
    out, at = [], 0
    for p in like:
        out.append(flat[at:at + p.size].reshape(p.shape).astype(np.float32))
        at += p.size
    return out


def _mix(t: pa.Table) -> pa.Table:
    """The average of one slice's parameters, weighted by tokens."""
    t = t.sort_by("part")
    n = sum(t.column("n").to_pylist())
    total = sum(np.frombuffer(v.as_py(), np.float32) * (k.as_py() / n) for v, k in zip(t.column("p"), t.column("n"), strict=True))
    return pa.table({"part": t.column("part")[:1], "slice": t.column("slice")[:1], "n": [n],
                     "p": pa.array([total.astype(np.float32).tobytes()], pa.binary())})


def fit(texts: DataFrame, warm: DataFrame, model: Model) -> Model:
    """Train on all ``texts`` (one column), from a warm start on ``warm``."""
    spark = texts.sparkSession

    def trainer(start, limit):
        def run(batches):
            from pyspark import TaskContext
            part, m = TaskContext.get().partitionId(), start.value
            t, number = Trainer(m, part + 1), _Numbers(m.vocab)
            kept, size = [], 0
            for _, ids, starts, _ in _encoded(batches, number):
                ids = np.where(ids < 0, m.tail[np.maximum(-1 - ids, 0)], ids)
                if limit is None:
                    t.text_ids(ids, starts)
                elif size < limit:
                    kept.append((ids, starts))
                    size += len(ids)
            while kept and t.tokens < limit:
                for ids, starts in kept:
                    t.text_ids(ids, starts)
            if t.tokens:
                flat = _pack(t.p)
                for i in range(0, len(flat), _SLICE):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part], pa.int64()), pa.array([i // _SLICE], pa.int32()), pa.array([float(t.tokens)]),
                         pa.array([flat[i:i + _SLICE].tobytes()], pa.binary())], ["part", "slice", "n", "p"])
        return run

    schema = "part long, slice int, n double, p binary"
    as_bytes = lambda df: df.select(F.col(df.columns[0]).cast("string").cast("binary"))

    def learned(rows) -> Model:
        if not rows:
            return model
        flat = np.concatenate([np.frombuffer(r["p"], np.float32) for r in sorted(rows, key=lambda r: r["slice"])])
        return replace(model, params=_unpack(flat, model.params))

    # the one task reads a few stored rows, not the table that they come from
    few = stored(as_bytes(warm), "lbl-warm").coalesce(1)
    model = learned(few.mapInArrow(trainer(spark.sparkContext.broadcast(model), WARM_TOKENS), schema).collect())
    return learned(as_bytes(texts).mapInArrow(trainer(spark.sparkContext.broadcast(model), None), schema)
                   .groupBy("slice", (F.col("part") % 64).alias("g")).applyInArrow(_mix, schema)
                   .groupBy("slice").applyInArrow(_mix, schema).collect())


class Scorer:
    """Normalised natural-log probabilities of both levels."""

    def __init__(self, model: Model):
        ctx, self.out, self.tops, c1, c2, self.bias, self.top_bias = model.params
        self.left, self.right, self.cls, self.lo = ctx @ c1, ctx @ c2, model.cls, model.lo
        self.n = len(self.out)

    @staticmethod
    def _log_sum(h: np.ndarray, e: np.ndarray, bias: np.ndarray) -> np.ndarray:
        out = np.empty(len(h), np.float32)
        block = max(1, (1 << 17) // len(e))                      # a block's scores stay in the cache
        e, ones = np.ascontiguousarray(e.T), np.ones(len(e), np.float32)
        with np.errstate(over="ignore", divide="ignore"):
            for i in range(0, len(h), block):
                z = h[i:i + block] @ e
                z += bias
                s = np.log(np.exp(z) @ ones)
                if not np.isfinite(s).all():                     # beyond the range of a float
                    top = z.max(axis=1)
                    s = np.log(np.exp(z - top[:, None]) @ ones) + top
                out[i:i + block] = s
        return out

    def __call__(self, w2: np.ndarray, w1: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Once for each distinct (w, w1, w2), in the order of w, hence of its class."""
        n = self.n
        key, place = np.unique((w.astype(np.int64) * n + w1) * n + w2, return_inverse=True)
        w, w1, w2 = key // (n * n), key // n % n, key % n
        h, k = self.left.take(w1, 0), self.cls[w]
        h += self.right.take(w2, 0)
        score = np.einsum("ij,ij->i", h, self.out.take(w, 0) + self.tops.take(k, 0)) + self.bias[w] + self.top_bias[k]
        score -= self._log_sum(h, self.tops, self.top_bias)
        first = np.flatnonzero(np.diff(k, prepend=-1))
        for a, b in zip(first, np.append(first[1:], len(k)), strict=True):
            own = slice(self.lo[k[a]], self.lo[k[a] + 1])
            score[a:b] -= self._log_sum(h[a:b], self.out[own], self.bias[own])
        return score[place].astype(np.float64)


def log_probs(model: Model, w2: np.ndarray, w1: np.ndarray, w: np.ndarray) -> np.ndarray:
    return Scorer(model)(w2, w1, w)


def score(docs: DataFrame, text: str, keep: list[str], c: Counts, model: Model) -> DataFrame:
    """``keep`` columns, n_tokens, n_known, base_score, score (log10) per row."""
    spark = docs.sparkSession
    base_den = math.log10(c.n + c.v + 1)
    shared = spark.sparkContext.broadcast((model, c.head, c.ends, np.log10(c.tails.sum(axis=0) + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, head, ends, tail_den = shared.value
        number = _Numbers(m.vocab)               # vocabulary ids, then those of the other head words
        vocab = len(m.params[0])
        others = [w for w in head if w not in m.vocab]
        number.update(zip(others, range(vocab, vocab + len(others)), strict=True))
        tails = np.array([_tail(w) for w in others] + [0], np.int64)
        count = np.zeros(vocab + len(others) + 1)                # at last: words without an id
        for w, i in number.items():
            count[i] = ends if w is END else head[w]
        logc, known = np.log10(count + 1), (count > 0).astype(np.int64)
        scorer = Scorer(m)
        for parts, ids, starts, unknown in _encoded(batches, number, rest=True):
            outside = (ids < 0) | (ids >= vocab)                 # words that share a tail token
            tail = np.where(ids < 0, np.maximum(-1 - ids, 0), tails[np.clip(ids - vocab, 0, len(others))])
            w = np.where(outside, m.tail[tail], ids)
            ids = np.where(ids < 0, len(count) - 1, ids)
            w2, w1 = contexts(w, starts, m.vocab[END])
            lp = scorer(w2, w1, w) / math.log(10) + np.where(outside, logc[ids] - tail_den[tail], 0)
            n = np.diff(np.append(starts, len(ids)))
            table = pa.Table.from_batches(parts).combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [*[table.column(j).chunk(0) for j in range(1, table.num_columns)], pa.array(n, pa.int64()),
                 pa.array(np.add.reduceat(known[ids], starts)), pa.array(np.add.reduceat(logc[ids], starts)),
                 pa.array(np.add.reduceat(lp, starts)), pa.concat_arrays(unknown)],
                [*keep, "n_tokens", "k", "s", "lp", "rest"])

    types = ", ".join(f"`{f}` {docs.schema[f].dataType.simpleString()}" for f in keep)
    src = docs.select(F.col(text).cast("string").cast("binary").alias("_text_in"), *keep)
    part = stored(src.mapInArrow(run, f"{types}, n_tokens long, k long, s double, lp double, "
                                      "rest array<struct<word:binary,tf:int>>")
                  .withColumn("row", F.monotonically_increasing_id()), "lbl-scores")
    words = part.select("row", F.explode("rest").alias("x")).select("row", "x.word", "x.tf")
    more = (words.join(c.table, "word", "left").groupBy("row").agg(
        F.sum(F.col("tf") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("s2"),
        F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("k2")))
    zero = F.lit(0.0)
    return (part.drop("rest").join(more, "row", "left").select(
        *keep, "n_tokens", (F.col("k") + F.coalesce("k2", F.lit(0))).alias("n_known"),
        (F.col("s") + F.coalesce("s2", zero) - F.col("n_tokens") * base_den).alias("base_score"),
        (F.col("lp") + F.coalesce("s2", zero)).alias("score")))


def warm_rows(docs: DataFrame, doc_id: str, text: str, n: int = WARM_DOCS) -> DataFrame:
    """The texts of at most ``n`` rows, those of smallest hash of id and text;
    rows that are equal in both count once."""
    rows = docs.select(F.xxhash64(F.col(doc_id), F.col(text)).alias("h"), F.col(text).alias("t"))
    last = rows.select("h").orderBy("h").limit(n).agg(F.max("h")).first()[0]
    return rows.filter(F.col("h") <= F.lit(last)).groupBy("h").agg(F.max("t").alias("t")).orderBy("h").select("t")


def train_and_score(docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text",
                    keep: list[str] | None = None, vocab: int | None = None, dim: int = DIM,
                    head: int = HEAD) -> tuple[DataFrame, Counts]:
    """Learn from the rows where ``learn`` holds and score all rows."""
    rows = docs.filter(learn)
    c = count(rows.select(text), head, vocab)
    model = fit(rows.select(text), warm_rows(rows, doc_id, text), new_model(c, dim))
    return score(docs, text, keep or [doc_id], c, model), c
