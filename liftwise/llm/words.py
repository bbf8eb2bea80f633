"""Words and word hashes of many texts at once (numpy; runs inside Spark tasks).

A word is a maximal run of letters and digits (Unicode general categories L and N) of the
lower-cased text. A word's 64-bit hash is a polynomial over mixed code points, so all words
of a batch are hashed by a few passes over one code-point array, without a Python loop.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

SHINGLE = 5
CHUNK_CHARS = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_STEP = 0xD6E8FEB86659FD93
U = np.uint64


@functools.cache
def _is_word() -> np.ndarray:
    return np.fromiter((chr(c).isalnum() for c in range(0x110000)), dtype=bool, count=0x110000)


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse, modulo 2**64."""
    up, down = np.full(n, _BASE, U), np.full(n, _BASE_INV, U)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=U), np.cumprod(down, dtype=U)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: nearby inputs give unrelated outputs."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def lower(text: str) -> str:
    """Lower case of the same length, so that offsets hold in the text as it came."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := ch.lower()) == 1 else ch for ch in text)


@dataclass
class Words:
    """Words of consecutive texts. `first[d]:first[d+1]` are the words of text d; `start` and
    `end` are code-point offsets in it. `part` hashes parts of the words."""

    hash: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    _at: np.ndarray  # start in the joined texts
    _sums: np.ndarray  # polynomial prefix sums over the joined texts

    def part(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the words' code points from offset `begin` to `end` (within each word)."""
        s, e = self._at + begin, self._at + end
        return mix((self._sums[e] - self._sums[s]) * _powers(1 << max(20, len(self._sums).bit_length()))[1][s] + (e - s).astype(U))


def words_of(texts: list[str]) -> Words:
    lowered = [lower(t) for t in texts]
    c = codes("\n".join(lowered) + "\n")
    lens = np.fromiter((len(t) + 1 for t in lowered), np.int64, len(lowered))
    base = np.concatenate(([0], np.cumsum(lens)))
    w = _is_word()[c]
    edge = np.flatnonzero(np.diff(w, prepend=False, append=False))
    s, e = edge[0::2], edge[1::2]
    up, down = _powers(1 << max(20, (len(c) + 1).bit_length()))
    v = mix(c.astype(U) + U(1))
    v *= up[: len(c)]
    p = np.concatenate((np.zeros(1, U), np.cumsum(v, dtype=U)))
    h = mix((p[e] - p[s]) * down[s] + (e - s).astype(U))
    first = np.searchsorted(s, base).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(h, first, s - base[doc], e - base[doc], s, p)


def shingles_of(w: Words, d: int, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the runs of `size` words of text d, by position. A text of fewer words has
    one shingle, the whole of it; a text without words has none."""
    h = w.hash[w.first[d] : w.first[d + 1]]
    n = len(h) - size + 1
    if not len(h):
        return h
    if n < 1:
        size, n = len(h), 1
    out = np.zeros(n, U)
    for j in range(size):
        out = out * U(_STEP) + h[j : j + n]
    return mix(out + U(size))


def chunks(texts: list[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Index ranges of texts of about `limit` characters together; a longer text is alone."""
    a, total = 0, 0
    for i, t in enumerate(texts):
        if total and total + len(t) > limit:
            yield a, i
            a, total = i, 0
        total += len(t)
    if a < len(texts):
        yield a, len(texts)
