"""Token ids of whole texts by a public tokenizer file, for use inside tasks.

Byte-level BPE without a normaliser never joins characters across a blank that a
visible character follows, nor across a single line break, so a text is cut
there and the ids of its pieces are remembered: a piece seen before costs a
lookup. New pieces of common Latin
characters are cut into the tokenizer's own words, remembered too, which go to
its model directly; all others, and all texts of other kinds of tokenizers, go
through its whole chain. The ids equal those of one call over the text (tests compare them).
"""

from __future__ import annotations

import json
import re
import sys
from array import array

import numpy as np
import public_tokenizers
import regex
from tokenizers import Tokenizer

KNOWN = 600_000          # remembered pieces of a worker: twice as many at most, the older ones go
_LONG = 80               # longer pieces are rare and not remembered
_DOUBLE = re.compile(r"\s(?=\s|\Z)")
_PLAIN = re.compile("[\n\x20-\x7e\xa1-ɏ]+")
_LETTERS = re.compile("[A-Za-zªµºÀ-ÖØ-öø-ɏ]+")
_LOADED: dict[str, "Encoder"] = {}


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE writes for each byte: itself where it is
    visible, else the next free one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Pieces(dict):
    """Piece -> its ids; a missing one comes from the generation before, or is
    made by the encoder."""

    def __init__(self, make, old: dict):
        super().__init__()
        self.make, self.old = make, old

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.make(piece)
        if len(piece) <= _LONG:
            self[piece] = ids
        return ids

    def bounded(self) -> "_Pieces":
        return self if len(self) < KNOWN else _Pieces(self.make, dict(self))


class Encoder:
    """``ids(text)``: the ids as little-endian bytes of ``dtype``."""

    def __init__(self, path: str):
        if sys.byteorder != "little":
            raise RuntimeError("ids are written in the machine's order: little-endian only")
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(True) <= 1 << 16 else "<u4")
        spec = json.loads(self.tokenizer.to_str())
        pre, added = spec["pre_tokenizer"] or {}, [a["content"] for a in spec["added_tokens"]]
        self.cuts = (spec["model"]["type"] == "BPE" and not spec["normalizer"] and not spec["model"]["dropout"]
                     and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
                     and not any(" " in a or a.isalpha() for a in added))
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        self.letters, self.words = _byte_letters(), regex.compile(public_tokenizers.PATTERN)
        self.model, self.code = self.tokenizer.model, "H" if self.dtype.itemsize == 2 else "I"
        if self.cuts:
            self.model._resize_cache(0)                    # words come once; the model's own memory only costs
        self.known = _Pieces(self._after_blank, {})       # by the piece without the blank before it
        self.bare = _Pieces(self._piece, {})              # pieces and words without a blank before them

    def _bytes(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def _tokens(self, mapped: str) -> bytes:
        return array(self.code, [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def _word(self, word: str) -> bytes:
        """The ids of one of the tokenizer's words."""
        if word[0] == " " and _LETTERS.fullmatch(word, 1):
            return self.known[word[1:]]
        return self._tokens(word.encode().decode("latin-1").translate(self.letters))

    def _after_blank(self, piece: str) -> bytes:
        if piece.isascii() and piece.isalpha():
            return self._tokens("Ġ" + piece)
        if len(piece) <= _LONG:
            if _LETTERS.fullmatch(piece):
                return self._tokens("Ġ" + piece.encode().decode("latin-1").translate(self.letters))
            if piece[-1] in ".," and _LETTERS.fullmatch(piece[:-1]) and not self.added.search(piece):
                return self.known[piece[:-1]] + self.bare[piece[-1]]
        return self._piece(" " + piece)

    def _piece(self, piece: str) -> bytes:
        """The ids of a piece that begins and ends where words do."""
        if len(piece) > _LONG or not _PLAIN.fullmatch(piece) or self.added.search(piece):
            return self._bytes(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        return b"".join(map(self._word, self.words.findall(piece)))

    def ids(self, text: str) -> bytes:
        if not self.cuts:
            return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
        self.known, self.bare = self.known.bounded(), self.bare.bounded()
        after, bare = self.known.__getitem__, self.bare.__getitem__
        if not _DOUBLE.search(text):
            lines = [line.split(" ") for line in text.split("\n")]
            return bare("\n").join([b"".join((bare(p[0]) if p[0] else b"", *map(after, p[1:]))) for p in lines])
        parts = []
        for i, p in enumerate(text.split(" ")):            # a blank before white space is no border
            if i and (not p or p[0].isspace()):
                parts[-1] += " " + p
            else:
                parts.append(p)
        return b"".join((bare(parts[0]) if parts[0] else b"", *map(after, parts[1:])))


def encoder(path: str) -> Encoder:
    """The worker's encoder of a file, loaded once."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]
