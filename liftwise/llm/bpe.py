"""Byte-level BPE encoding by traversal of a trie of words, and decoding.

A text is split into words as the tokenizer file says; the distinct words that a worker has not
met are put into a trie, and a depth-first traversal carries along the path, for every
prefix, the last token of that prefix's encoding. The encoding of a prefix ends in the one
token t that is a suffix of it and is compatible with the last token u of what is before t;
then the rest is the encoding of that. So a prefix shared by many words is computed once, and
a word's ids are read back from its node through the last tokens.

u and t are compatible if merging the bytes of both gives u and t again: no token on u's right
edge merges with one on t's left edge before the edge token is taken up by the merge that
makes its own parent (at equal rank the merge further left is first). This needs a vocabulary
in which each token comes from one merge of two tokens of earlier ranks; files without this,
or with options the traversal does not know, are refused.

Plan: one pass over the texts, no shuffle. Word encodings are kept per Python worker up to
`CACHE_BYTES`, the trie holds the new words of a chunk of texts. A task that runs again gives
the same rows.

Defined results: a null text is the empty text, which has no ids; null ids of rows stay null;
repeated rows give a row each; special tokens written out in a text become their ids, as in
the tokenizers library by default; decoding takes ids that the vocabulary does not have as
nothing, and bytes that are no UTF-8 as replacement characters; an empty table gives no rows.
Only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

import functools
import json
import re
import struct
from collections import deque
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftwise.llm.common import id_text
from liftwise.llm.tokens import _byte_letters, default_path
from liftwise.llm.words import chunks

TOKENIZER = "byte_bpe_50k.json"
CACHE_BYTES = 96 << 20  # of word encodings in a worker
ENTRY_BYTES = 220  # of a cached word besides its own bytes and ids, about
NEVER = 1 << 60

#: Fixed value: the split of byte-level tokenizers (contractions, letters, numbers, other signs,
#: each with one leading space; white space but the last before a word), in the classes of `re`.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"


class Trie:
    """A trie of distinct words, laid out depth first: the words in order, each with the depth of
    the node at which it leaves the path of the word before (the length they share)."""

    def __init__(self, words: list[bytes]):
        self.order = sorted(range(len(words)), key=words.__getitem__)
        self.words = [words[k] for k in self.order]
        self.depth = [0] * len(words)
        old = b""
        for k, w in enumerate(self.words):
            n = min(len(old), len(w))
            differ = int.from_bytes(old[:n]) ^ int.from_bytes(w[:n])
            self.depth[k] = n - (differ.bit_length() + 7) // 8
            old = w


class Tokens:
    """The bytes of each id of a byte-level BPE file (what decoding needs)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.spec = spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        known = model["type"] == "BPE" and not any(
            model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        )
        plain = not any(t.get(k) for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        split = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        if not (known and plain and split and spec["normalizer"] is None and (spec["decoder"] or {}).get("type") == "ByteLevel"):
            raise ValueError(f"{path}: expected a plain byte-level BPE")
        byte = {letter: b for b, letter in enumerate(_byte_letters())}
        self.id_of = {bytes([byte[x] for x in token]): i for token, i in model["vocab"].items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*self.id_of.values(), *self.added.values()]) + 1
        if size > 1 << 20:
            raise ValueError(f"{path}: ids beyond 2**20")
        self.token = [b""] * size
        for raw, i in self.id_of.items():
            self.token[i] = raw
        for text, i in self.added.items():
            self.token[i] = text.encode()
        lens = np.array([len(t) for t in self.token] + [0])  # one more, for ids beyond the vocabulary
        self._joined = np.frombuffer(b"".join(self.token), np.uint8), np.cumsum(lens) - lens, lens

    def decode(self, raw: bytes) -> str:
        blob, start, lens = self._joined
        ids = np.minimum(np.frombuffer(raw, "<u4"), len(lens) - 1).astype(np.int64)
        n = lens[ids]
        at = np.repeat(start[ids] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return blob[at].tobytes().decode("utf-8", "replace")


class ByteBpe(Tokens):
    """Encoding with a byte-level BPE file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__(path)
        model, id_of, size = self.spec["model"], self.id_of, len(self.token)
        self.library = Tokenizer.from_file(path)
        self._size = [len(t) for t in self.token]
        self._read_merges(model["merges"], model["vocab"], size)
        self._match_suffixes(id_of)
        del self.spec, self.id_of
        self._pair: dict[int, bool] = {}
        self._edges_left: dict[int, list] = {}
        self._edges_right: dict[int, list] = {}
        self._odd: dict[str, bool] = {}
        self._split = re.compile(SPLIT).findall
        self._specials = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self._first = list(self.added)
        self.known: dict[str, tuple[bytes, int]] = {}
        self._held = 0

    def _read_merges(self, merges: list, vocab: dict[str, int], size: int) -> None:
        """Rank of each pair of ids, and the two parts and the rank of each token."""
        self.rank: dict[int, int] = {}  # by first << 20 | second
        self.parts: list[tuple[int, int] | None] = [None] * size
        self.made: list[int] = [-1] * size
        for r, pair in enumerate(merges):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y, t = vocab[a], vocab[b], vocab[a + b]
            if self.parts[t] is not None or max(self.made[x], self.made[y]) >= r:
                raise ValueError("a token with two merges, or of a later part")
            self.rank[x << 20 | y], self.parts[t], self.made[t] = r, (x, y), r

    def _match_suffixes(self, id_of: dict[bytes, int]) -> None:
        """An automaton over the tokens: `_goto[state * 256 + byte]`, `_fail[state]`, the longest
        token that a state's string ends in, and each token's next shorter one (-1: none)."""
        goto, fail, longest = {}, [0], [-1]
        end_of = {}
        for raw, i in id_of.items():
            k = 0
            for b in raw:
                nxt = goto.get(k * 256 + b)
                if nxt is None:
                    nxt = goto[k * 256 + b] = len(longest)
                    longest.append(-1)
                k = nxt
            longest[k], end_of[k] = i, i
        below: list[list[tuple[int, int]]] = [[] for _ in longest]
        for key, nxt in goto.items():
            below[key >> 8].append((key & 255, nxt))
        fail = [0] * len(longest)
        self._shorter = [-1] * len(self.token)
        todo = deque(k for _, k in below[0])
        while todo:
            k = todo.popleft()
            if k in end_of:
                self._shorter[end_of[k]] = longest[fail[k]]
            else:
                longest[k] = longest[fail[k]]
            for b, nxt in below[k]:
                f = fail[k]
                while f and f * 256 + b not in goto:
                    f = fail[f]
                fail[nxt] = goto.get(f * 256 + b, 0)
                todo.append(nxt)
        self._goto, self._fail, self._longest = goto, fail, longest

    def _edge(self, t: int, side: int) -> list[tuple[int, int]]:
        """(token, rank of the merge that takes it up) along the right (1) or left (0) edge of t."""
        out, taken = [], NEVER
        while True:
            out.append((t, taken))
            if self.parts[t] is None:
                return out
            t, taken = self.parts[t][side], self.made[t]

    def compatible(self, u: int, t: int) -> bool:
        """Whether the bytes of u and t together are encoded as u, t."""
        key = u << 20 | t
        got = self._pair.get(key)
        if got is None:
            right = self._edges_right.get(u) or self._edges_right.setdefault(u, self._edge(u, 1))
            left = self._edges_left.get(t) or self._edges_left.setdefault(t, self._edge(t, 0))
            rank = self.rank
            got = True
            for x, x_taken in right:
                for y, y_taken in left:
                    r = rank.get(x << 20 | y)
                    if r is not None and r < x_taken and r <= y_taken:
                        got = False
                        break
                if not got:
                    break
            if len(self._pair) >= 1 << 20:
                self._pair.clear()
            self._pair[key] = got
        return got

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word: trie, depth-first traversal, last token of every prefix."""
        trie = Trie(words)
        out: list[list[int]] = [[]] * len(words)
        goto, fail, longest, shorter, compatible = self._goto, self._fail, self._longest, self._shorter, self.compatible
        size, fits = self._size, self._pair
        last, states = [-1], [0]  # by depth of the path: last token of the prefix, and the automaton's state
        for number, w, depth in zip(trie.order, trie.words, trie.depth, strict=True):
            del last[depth + 1 :], states[depth + 1 :]
            state = states[depth]
            for d in range(depth, len(w)):
                b = w[d]
                nxt = goto.get(state * 256 + b)
                while nxt is None and state:
                    state = fail[state]
                    nxt = goto.get(state * 256 + b)
                state = nxt or 0
                states.append(state)
                t = longest[state]
                while t >= 0:
                    before = d + 1 - size[t]
                    if not before:
                        break
                    u = last[before]
                    fit = fits.get(u << 20 | t)
                    if compatible(u, t) if fit is None else fit:
                        break
                    t = shorter[t]
                else:
                    raise ValueError("the vocabulary lacks a byte")
                last.append(t)
            ids, d = [], len(w)
            while d:
                ids.append(last[d])
                d -= size[last[d]]
            ids.reverse()
            out[number] = ids
        return out

    def _is_odd(self, ch: str) -> bool:
        """Whether the pattern's classes and the library's differ for a character."""
        probe = f"a{ch} 1{ch} !{ch} {ch}{ch}a"
        odd = self._odd[ch] = self._split(probe) != self._library_split(probe)
        return odd

    def _library_split(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def split(self, text: str) -> list[str]:
        """Words of a text without special tokens."""
        odd = self._odd
        if any([odd[ch] if ch in odd else self._is_odd(ch) for ch in set(text)]):
            return self._library_split(text)
        return self._split(text)

    def _parts(self, text: str) -> Iterator[tuple[list[str], int | None]]:
        """Words up to each special token, and its id."""
        at = 0
        if self._specials is not None and any(x in text for x in self._first):
            for found in self._specials.finditer(text):
                yield self.split(text[at : found.start()]), self.added[found.group()]
                at = found.end()
        yield self.split(text[at:] if at else text), None

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if self._held > CACHE_BYTES:
            self.known, self._held = {}, 0
        parts = [list(self._parts(t)) for t in texts]
        known = self.known
        met = set(chain.from_iterable(ws for ps in parts for ws, _ in ps))
        new = [w for w in met if w not in known]
        for w, ids in zip(new, self.encode_words([w.encode() for w in new]), strict=True):
            known[w] = raw = struct.pack(f"<{len(ids)}I", *ids)
            self._held += len(raw) + 2 * len(w) + ENTRY_BYTES
        end = {i: struct.pack("<I", i) for i in self.added.values()} | {None: b""}
        return [b"".join([b"".join(map(known.__getitem__, ws)) + end[special] for ws, special in ps]) for ps in parts]


@functools.lru_cache(maxsize=1)
def vocabulary(path: str) -> ByteBpe:
    """One per Python worker."""
    return ByteBpe(path)


@functools.lru_cache(maxsize=1)
def tokens(path: str) -> Tokens:
    return Tokens(path)


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids): the ids of each whole text as little-endian unsigned 32-bit integers."""
    path = tokenizer or default_path(TOKENIZER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in chunks(texts):
                raw = bpe.encode(texts[a:b])
                n = pa.array([len(x) // 4 for x in raw], pa.int64())
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), n, pa.array(raw, pa.binary())], names=["doc_id", "n_tokens", "ids"])

    return id_text(df, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(df: DataFrame, ids_col: str = "ids", tokenizer: str | None = None) -> DataFrame:
    """`df` with a column `decoded`, the text of the ids; null ids give a null text. A column of
    that name is replaced."""
    path = tokenizer or default_path(TOKENIZER)
    rest = df.drop("decoded")
    k = rest.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = tokens(path)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                texts = [None if x is None else vocab.decode(x) for x in part.column(k).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "decoded"])

    schema = rest.withColumn("decoded", F.lit(None).cast("string")).schema
    return rest.mapInArrow(run, schema)
