"""Word shingles of texts as 64-bit hashes, computed on whole Arrow batches.

Words are runs of characters other than 0x20 and 0x09-0x0D, ASCII letters in
lower case. A word hashes to a polynomial of its bytes modulo 2^64, taken from
running sums, then mixed with its length; a shingle to a polynomial of its
words' hashes, mixed again. Equal words give equal hashes in any batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = 0xD1342543DE82EF95
_MASK = (1 << 64) - 1
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_LOWER += np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: dict[str, np.ndarray] = {}
_PACK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(name: str, base: int, n: int) -> np.ndarray:
    """base^0 .. base^n modulo 2^64."""
    have = _POWERS.get(name)
    if have is None or len(have) <= n:
        m = max(n + 1, 1 << 16)
        have = np.empty(m, np.uint64)
        have[0] = 1
        done = 1
        while done < m:                                   # doubling: base^(done + i) = base^done * base^i
            step = np.uint64(pow(base, done, 1 << 64))
            k = min(done, m - done)
            have[done:done + k] = have[:k] * step
            done += k
        _POWERS[name] = have
    return have


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts data[offsets[i]:offsets[i + 1]], and the
    number of the text each belongs to."""
    space = _SPACE[data]
    word = ~space
    start = word.copy()
    start[1:] &= space[:-1]
    edge = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[edge] = word[edge]                              # a text's first byte starts a word
    begin = np.flatnonzero(start)
    if not len(begin):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    stop = np.empty(len(data), bool)
    stop[:-1] = word[:-1] & (space[1:] | start[1:])
    stop[-1] = word[-1]
    end = np.flatnonzero(stop) + 1
    n = len(data)
    power = _power("up", _BASE, n)
    inverse = _power("down", pow(_BASE, -1, 1 << 64), n)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_LOWER[data] * power[:n], dtype=np.uint64)))
    h = (total[end] - total[begin]) * inverse[begin]
    h = mix(h + (end - begin).astype(np.uint64) * np.uint64(_STEP))
    return h, np.searchsorted(offsets, begin, side="right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: ``k`` words each; a shorter
    text has its whole sequence as the only one; none without words."""
    h, text = word_hashes(data, offsets)
    n = len(offsets) - 1
    counts = np.bincount(text, minlength=n)
    ends = np.cumsum(counts)
    if len(h) >= k:
        value = np.zeros(len(h) - k + 1, np.uint64)
        for j in range(k):
            value = value * np.uint64(_STEP) + h[j:len(h) - k + 1 + j]
        value = mix(value + np.uint64(k))
    out = []
    for i in range(n):
        c, lo = int(counts[i]), int(ends[i] - counts[i])
        if c == 0:
            out.append(np.empty(0, np.uint64))
        elif c < k:
            v = np.zeros(1, np.uint64)
            for x in h[lo:lo + c]:
                v = v * np.uint64(_STEP) + x
            out.append(mix(v + np.uint64(c)))
        else:
            s = np.sort(value[lo:lo + c - k + 1])
            out.append(s if c == k else s[np.concatenate(([True], s[1:] != s[:-1]))])
    return out


def batch_sets(texts: pa.Array, k: int = 5) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sets) over packs of rows of a binary column, bounded in bytes
    unless one text is longer; a null is a text without words."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    lo = 0
    while lo < len(texts):
        hi = int(np.searchsorted(offsets, offsets[lo] + _PACK_BYTES, side="right")) - 1
        hi = min(max(hi, lo + 1), len(texts))
        yield lo, shingle_sets(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], k)
        lo = hi
