"""Language identification with hyperdimensional profiles.

Every letter gets a random +-1 vector of ``dim`` components, drawn from a hash
of its code point, so all tasks agree without a shared table. A trigram vector
binds its letters by product after cyclic permutation by their place: rho^2(a)
* rho(b) * c. A text is the bundle (sum) of its trigram vectors, a language
the bundle of the texts labelled with it, and a text goes to the language of
the highest cosine. Texts are lower-cased; a run of characters that are not
letters counts as one space, and so do both ends.

Bundling is linear, so training is one distributed sum of integer vectors over
all labelled rows: one vector per language and task, added in two levels. What
reaches the driver is one vector per language (``MAX_LANGS`` at most, checked).

Nulls: null text, or text without a letter, gives ``und`` with score 0 and is
not learned from; so does any text when nothing was learned. Null labels are
not learned from. Ties go to the smaller language value.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIM = 1024
MAX_LANGS = 8192
UND = "und"
_SPACE = 0x20
_ALPHA: np.ndarray | None = None


@dataclass
class Profiles:
    langs: list[str]
    matrix: np.ndarray            # one unit vector per language


def _alpha() -> np.ndarray:
    """For every code point, whether it is a letter (built once per worker)."""
    global _ALPHA
    if _ALPHA is None:
        _ALPHA = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _ALPHA


def letter_vectors(points: np.ndarray, dim: int) -> np.ndarray:
    """One +-1 row per code point, from splitmix64 of (code point, word)."""
    words = dim // 64
    z = points.astype(np.uint64)[:, None] * np.uint64(words) + np.arange(words, dtype=np.uint64)
    with np.errstate(over="ignore"):
        z = (z + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    bits = np.unpackbits(np.ascontiguousarray(z).view(np.uint8), axis=1)
    return (bits.astype(np.int8) * 2 - 1)


def _letters(text: str | None) -> np.ndarray:
    """Code points of the lower-cased text, each run of other characters as one
    space, a space at both ends; empty if there is no letter."""
    if not text:
        return np.empty(0, np.uint32)
    p = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    ok = _alpha()[p]
    if not ok.any():
        return np.empty(0, np.uint32)
    p = np.where(ok, p, _SPACE)
    p = np.concatenate(([_SPACE], p, [_SPACE]))
    gap = p == _SPACE
    return p[~(gap & np.concatenate(([False], gap[:-1])))]


def bundles(texts: Sequence[np.ndarray], groups: Sequence[int], n: int, dim: int) -> np.ndarray:
    """Sum of the trigram vectors of each group of texts: ``n`` rows."""
    flat = np.concatenate(texts)
    mark = np.zeros(0x110000, bool)
    mark[flat] = True
    points = np.flatnonzero(mark)
    m = len(points)
    rank = np.zeros(0x110000, np.int32)
    rank[points] = np.arange(m)
    flat = rank[flat].astype(np.int64)
    codes, owner, at = [], [], 0
    for t, g in zip(texts, groups, strict=True):
        x = flat[at:at + len(t)]
        at += len(t)
        codes.append((x[:-2] * m + x[1:-1]) * m + x[2:])
        owner.append(np.full(len(codes[-1]), g))
    code, own = np.concatenate(codes), np.concatenate(owner)
    if m ** 3 <= 1 << 22:
        seen = np.zeros(m ** 3, bool)
        seen[code] = True
        grams = np.flatnonzero(seen)
        place = np.zeros(m ** 3, np.int64)
        place[grams] = np.arange(len(grams))
        inv = place[code]
    else:
        grams, inv = np.unique(code, return_inverse=True)
    vec = letter_vectors(points, dim)
    second, first = np.roll(vec, 1, axis=1), np.roll(vec, 2, axis=1)
    out = np.zeros((n, dim))
    for lo in range(0, len(grams), 1 << 14):              # bounds the table of trigram vectors
        part = grams[lo:lo + (1 << 14)]
        here = (inv >= lo) & (inv < lo + len(part)) if len(grams) > 1 << 14 else slice(None)
        counts = np.bincount(own[here] * len(part) + inv[here] - lo,
                             minlength=n * len(part)).reshape(n, len(part))
        table = first[part // (m * m)] * second[part // m % m] * vec[part % m]
        out += (counts.astype(np.float32) @ table.astype(np.float32)
                if counts.max() < 1 << 12 else counts.astype(np.float64) @ table.astype(np.float64))
    return out


def _packs(texts: Sequence[str | None], rows: int = 48, chars: int = 1 << 19) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, letters of each row): packs bounded by rows and characters."""
    at, pack, size = 0, [], 0
    for i, t in enumerate(texts):
        x = _letters(t)
        if pack and (len(pack) == rows or size + len(x) > chars):
            yield at, pack
            at, pack, size = i, [], 0
        pack.append(x)
        size += len(x)
    if pack:
        yield at, pack


def train(df: DataFrame, text: str = "text", label: str = "lang", dim: int = DIM) -> Profiles:
    """Learn one profile per label value from all rows of ``df``."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            texts, labels = b.column(0).to_pylist(), b.column(1).to_pylist()
            for at, pack in _packs(texts):
                use = [(labels[at + i], x) for i, x in enumerate(pack) if len(x) and labels[at + i] is not None]
                if use:
                    names = sorted({g for g, _ in use})
                    got = bundles([x for _, x in use], [names.index(g) for g, _ in use], len(names), dim)
                    for g, row in zip(names, got, strict=True):
                        sums[g] = sums[g] + row if g in sums else row
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
                ["lang", "vec"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(dim)
        for v in table.column("vec"):
            total += np.frombuffer(v.as_py())
        return pa.table({"lang": table.column("lang").slice(0, 1), "vec": pa.array([total.tobytes()], pa.binary())})

    schema = "lang string, vec binary"
    sums = (df.filter(F.col(label).isNotNull() & F.col(text).isNotNull())
              .select(F.col(text).cast("string").alias("t"), F.col(label).cast("string").alias("l"))
              .mapInArrow(partial, schema)
              .withColumn("part", F.spark_partition_id() % 64))
    some = sums.groupBy("lang", "part").applyInArrow(
        lambda t: add(t.select(["lang", "vec"])), schema)
    rows = some.groupBy("lang").applyInArrow(add, schema).limit(MAX_LANGS + 1).collect()
    if len(rows) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} language labels")
    rows.sort(key=lambda r: r["lang"])
    m = np.array([np.frombuffer(r["vec"]) for r in rows]).reshape(len(rows), dim)
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return Profiles([r["lang"] for r in rows], m / np.where(norm > 0, norm, 1))


def predict(df: DataFrame, profiles: Profiles, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (cosine, 0 to 1) to ``df``.

    ``keep``: columns to return besides (default all); a column of ``df`` that
    has the name of an output is replaced.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast((profiles.langs, profiles.matrix))
    fields = [df.schema[c] for c in keep]
    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, matrix = shared.value
        for b in batches:
            names, scores = [], []
            for _, pack in _packs(b.column(b.num_columns - 1).to_pylist()):
                some = [i for i, x in enumerate(pack) if len(x)]
                best, cos = np.full(len(pack), -1), np.zeros(len(pack))
                if some and langs:
                    v = bundles([pack[i] for i in some], range(len(some)), len(some), matrix.shape[1])
                    c = v @ matrix.T
                    best[some] = c.argmax(axis=1)
                    length = np.linalg.norm(v, axis=1)
                    cos[some] = np.clip(c.max(axis=1) / np.where(length > 0, length, 1), 0, 1)
                names += [langs[k] if k >= 0 else UND for k in best]
                scores += cos.tolist()
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                [*keep, "lang_pred", "score"])

    src = df.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("string").alias("_text_in"))
    return src.mapInArrow(run, schema)


def identify(df: DataFrame, train_on: Column, text: str = "text", label: str = "lang",
             keep: Sequence[str] | None = None, dim: int = DIM) -> DataFrame:
    """Learn from the rows of ``df`` where ``train_on`` holds, predict all rows."""
    return predict(df, train(df.filter(train_on), text, label, dim), text, keep)
