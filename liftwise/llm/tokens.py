"""Token ids by a public tokenizer file, with repeated pieces of text encoded once per task.

The tokenizer (lower-casing BPE with word ends) drops white space and never joins across it,
so a text's ids are those of its white-space separated pieces, and a piece's ids are those
of its words, in order. Both are cached; a new word is encoded by the tokenizer's own model.
A call sets signs after a letter apart, in lower case, so that a word has one piece, looks
each distinct piece up once, and gathers the texts' ids in arrays.
Texts to which this does not apply (control characters that only Python takes for white
space, letters and numbers whose classes or lower case differ, special-token strings) are
encoded whole by the tokenizer.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TOKENIZER = "word_bpe_49k.json"
CACHE_BYTES = 72 << 20  # of each generation of pieces in a worker; other words have an eighth
ENTRY_BYTES = 200  # of an entry besides its text and ids, about


def default_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> list[str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for
    the code points from 256 on, in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class _Cache(dict):
    """Text -> ids, bounded by bytes: two generations, of which the older one goes when the
    younger is full; what is asked for again moves to the younger."""

    part = 1

    def __init__(self):
        self.held = 0
        self.old: dict[str, bytes] = {}

    def keep(self, text: str, raw: bytes) -> bytes:
        if self.held * self.part >= CACHE_BYTES:
            self.old = dict(self)
            self.clear()
            self.held = 0
        self.held += len(raw) + 2 * len(text) + ENTRY_BYTES
        self[text] = raw
        return raw

    def __missing__(self, text: str) -> bytes:
        raw = self.old.get(text)
        return self.keep(text, self.encoded(text) if raw is None else raw)


class _Pieces(_Cache):
    """White-space separated piece -> ids."""

    def __init__(self, words: _Words):
        super().__init__()
        self.words = words

    def encoded(self, piece: str) -> bytes:
        w = self.words
        if piece.isascii() and piece.isalpha():  # a word is kept once, as its lower-case piece
            low = piece.lower()
            return w.encoded(piece) if low == piece else self[low]
        words = w.split(unicodedata.normalize("NFC", piece).lower())
        return b"".join([self[x] if x.isascii() and x.isalpha() else w[x] for x in words])


class _Words(_Cache):
    """Lower-case word that is no piece of plain letters -> ids."""

    #: The tokenizer's split: contractions, letters, one digit, other signs.
    split = staticmethod(re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+").findall)

    part = 8

    def __init__(self, model):
        super().__init__()
        self.tokenize, self.letters = model.tokenize, {b: x for b, x in enumerate(_byte_letters())}

    def encoded(self, word: str) -> bytes:
        mapped = word if word.isascii() and word.isalpha() else word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.tokenize(mapped)]).tobytes()


class _OddCharacters(dict):
    """Character -> whether _Words.split may read it otherwise than the tokenizer: separators
    that only Python takes for white space, numbers that are not digits, marks, and letters
    with a context-dependent lower case."""

    def __missing__(self, ch: str) -> bool:
        self[ch] = odd = "\x1c" <= ch <= "\x1f" or ch in "Σİ" or unicodedata.category(ch) in ("Nl", "No", "Mn", "Mc", "Me")
        return odd


_BYTES = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_LETTER = (_LOWER >= 97) & (_LOWER <= 122)
_SIGN = (_BYTES > 32) & (_BYTES < 127) & ~_LETTER


def _apart(texts: list[str]) -> pa.Array:
    """The texts, A to Z in lower case, with a space between each of these letters and an ASCII
    sign or digit after it. A word ends there in _Words.split, so the words are the same."""
    plain = pa.array(texts, pa.large_string())
    _, offsets, data = plain.buffers()
    if not data or not data.size:
        return plain
    at = np.frombuffer(offsets, np.int64, len(texts) + 1)
    raw = np.frombuffer(data, np.uint8, int(at[-1]))
    cuts = np.flatnonzero(_LETTER[raw[:-1]] & _SIGN[raw[1:]]) + 1
    # a cut where a text begins goes to the text before
    at = at + np.searchsorted(cuts, at, "right")
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(at), pa.py_buffer(np.insert(_LOWER[raw], cuts, 32)))


class PieceEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["normalizer"]["normalizers"][-1] != {"type": "Lowercase"} or spec["model"]["end_of_word_suffix"] != "</w>":
            raise ValueError("expected a lower-casing tokenizer with word ends")
        self.odd = _OddCharacters()
        self.pieces = _Pieces(_Words(self.tok.model))

    def whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def _plain(self, text: str) -> bool:
        odd = self.odd
        return "<|" not in text and not any([odd[ch] for ch in set(text)])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        plain = [self._plain(t) for t in texts]
        # Arrow splits at the same 29 characters as str.split
        pieces = pc.utf8_split_whitespace(_apart([t if p else "" for t, p in zip(texts, plain, strict=True)]))
        coded = pieces.flatten().dictionary_encode()
        known = self.pieces
        raws = [known[p] for p in coded.dictionary.to_numpy(zero_copy_only=False).tolist()]
        size = np.fromiter(map(len, raws), np.int64, len(raws)) // 4
        first = np.cumsum(size) - size
        k = coded.indices.to_numpy()
        n = size[k]
        ends = np.cumsum(n)
        at = np.repeat(first[k] - (ends - n), n)
        at += np.arange(len(at))
        ids = np.frombuffer(b"".join(raws), np.uint32)[at].tobytes()
        cuts = 4 * np.concatenate((np.zeros(1, np.int64), ends))[pieces.offsets.to_numpy()]
        spans = zip(cuts[:-1].tolist(), cuts[1:].tolist(), plain, texts, strict=True)
        return [ids[a:b] if p else self.whole(t) for a, b, p, t in spans]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """One per Python worker."""
    return PieceEncoder(path)
