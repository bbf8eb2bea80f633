"""Benchmark decontamination: BM25 index of test items, block-max WAND, exact overlap check.

Index. Test items are cut into parts of at most `part_words` words; a part is a document of
a BM25 index, its postings sorted by part and grouped in blocks with their largest weight. A
weight is divided by its part's whole score, so a passage that holds every word of a part
scores 1 and one threshold serves all parts.

Search. Every document is read whole, in passages of two part lengths that overlap by half,
so each part-sized run of words lies within one passage. A passage's distinct words are the
query; every part of score >= `theta` is retrieved, without a limit on their number. Parts
are grouped in ranges; array sums of the words' largest weights per range bound all passages
of a batch at once, and block-max WAND runs over the ranges that can reach the threshold.

Check. The item is looked up in the words around every passage retrieved for it; of those that
contain it the one of the best score is reported. The item is contained if at least
`overlap` of its question's five-word shingles and of its answer's occur. The answer is the
text after the last line break, or the last sentence; an item of one sentence has none.

The benchmark is collected in slices of about `slice_items` items, each slice one pass over
the documents, so what is sent to the tasks is bounded for a benchmark of any size. Document
frequencies and lengths are those of the whole benchmark, so scores do not depend on slices.

Defined results: null and empty texts contain nothing; items without words are skipped; a
null item_id or doc_id is carried as null; documents are searched each by itself, so repeated
rows give repeated results; repeated rows of the benchmark are one item; empty tables give no
rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftwise.llm.common import hold, id_text
from liftwise.llm.words import SHINGLE, Words, chunks, mix, words_of

U = np.uint64


@dataclass(frozen=True)
class Params:
    part_words: int = 64
    theta: float = 0.5
    overlap: float = 0.8
    k1: float = 1.2
    b: float = 0.75
    block: int = 8
    range_parts: int = 2
    max_ranges: int = 256
    slice_items: int = 20_000


def runs(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` words."""
    n = len(h) - size + 1
    if n < 1:
        return np.zeros(0, U)
    out = np.zeros(n, U)
    for j in range(size):
        out = out * U(0xD6E8FEB86659FD93) + h[j : j + n]
    return mix(out + U(size))


def split_item(text: str) -> tuple[str, str]:
    """(question, answer)."""
    text = text.strip()
    head, line, tail = text.rpartition("\n")
    if line:
        return head, tail
    ends = [m.end() for m in re.finditer(r"[.!?]\s+", text)]
    return (text[: ends[-1]], text[ends[-1] :]) if ends else (text, "")


@dataclass
class Posting:
    parts: list[int]
    weights: list[float]
    block_last: list[int]  # last part of each block
    block_max: list[float]
    top: float


@dataclass(frozen=True)
class Statistics:
    """Of all parts of a benchmark: their number and mean length, and in how many of them each
    of some words occurs (`words` sorted)."""

    n: int
    mean: float
    words: np.ndarray
    counts: np.ndarray


def part_bags(h: np.ndarray, p: Params) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct words and their counts of each part of an item."""
    return [np.unique(h[at : at + p.part_words], return_counts=True) for at in range(0, len(h), p.part_words)]


class Index:
    """`of_all`: statistics of the whole benchmark, where the items are a slice of it."""

    def __init__(self, items: list[tuple[int | None, str]], p: Params, of_all: Statistics | None = None):
        self.p = p
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.shingles: list[tuple[tuple[int, np.ndarray], ...]] = []  # of question and answer
        self.part_item: list[int] = []
        bags: list[tuple[np.ndarray, np.ndarray]] = []
        for item_id, text in items:
            q, a = split_item(text or "")
            w = words_of([q, a])
            h = w.hash
            if not len(h):
                continue
            both = (h[: w.first[1]], h[w.first[1] :])
            sides = []
            for x in both:
                if len(x):
                    size = min(SHINGLE, len(x))
                    sides.append((size, np.unique(runs(x, size))))
            own = part_bags(h, p)
            bags += own
            self.part_item += [len(self.ids)] * len(own)
            self.ids.append(item_id)
            self.lengths.append(len(h))
            self.shingles.append(tuple(sides))
        self._weigh(bags, of_all)

    def _weigh(self, bags: list[tuple[np.ndarray, np.ndarray]], of_all: Statistics | None) -> None:
        p, n = self.p, len(bags)
        self.vocabulary = np.unique(np.concatenate([h for h, _ in bags] or [np.zeros(0, U)]))
        part = np.repeat(np.arange(n), [len(h) for h, _ in bags])
        term = np.searchsorted(self.vocabulary, np.concatenate([h for h, _ in bags] or [np.zeros(0, U)]))
        tf = np.concatenate([c for _, c in bags] or [np.zeros(0)])
        df = np.bincount(term, minlength=len(self.vocabulary))
        length = np.bincount(part, tf, n)
        total, mean = n, max(length.sum() / n if n else 0, 1e-9)
        if of_all is not None:
            total, mean, df = of_all.n, of_all.mean, of_all.counts[np.searchsorted(of_all.words, self.vocabulary)]
        idf = np.log1p((total - df + 0.5) / (df + 0.5))
        weight = idf[term] * tf * (p.k1 + 1) / (tf + p.k1 * (1 - p.b + p.b * length[part] / mean))
        weight = weight / np.bincount(part, weight, n)[part]
        self.n_ranges = int(min(p.max_ranges, max(1, -(-n // p.range_parts))))
        self.range_of = np.arange(n) * self.n_ranges // max(n, 1)
        self.bound = np.zeros((len(self.vocabulary), self.n_ranges), np.float32)
        np.maximum.at(self.bound, (term, self.range_of[part]), weight.astype(np.float32))
        self.range_first = np.searchsorted(self.range_of, np.arange(self.n_ranges + 1))
        order = np.lexsort((part, term))
        cut = np.searchsorted(term[order], np.arange(len(self.vocabulary) + 1))
        self.postings: list[Posting] = []
        for a, b in zip(cut, cut[1:], strict=False):
            parts, ws = part[order[a:b]], weight[order[a:b]]
            blocks = range(0, b - a, p.block)
            self.postings.append(
                Posting(parts.tolist(), ws.tolist(), [int(parts[min(k + p.block, b - a) - 1]) for k in blocks], [float(ws[k : k + p.block].max()) for k in blocks], float(ws.max()))
            )

    def search(self, terms: list[int], first: int, end: int) -> list[tuple[int, float]]:
        """Block-max WAND: parts in [first, end) of score >= theta for a set of terms."""
        return block_max_wand([self.postings[t] for t in terms], self.p.theta, self.p.block, first, end)


def block_max_wand(lists: list[Posting], theta: float, block: int, first: int, end: int) -> list[tuple[int, float]]:
    """Document at a time. Cursors are kept in the order of their current part; the pivot is
    the first at which the lists' largest weights sum to the threshold. If the current blocks
    cannot reach it, all cursors move past the nearest block end; else the pivot is scored."""
    slack = theta - 1e-9
    found = []
    cursors = []  # [part, position, list]
    for p in lists:
        k = _seek(p, 0, first, block)
        if k < len(p.parts) and p.parts[k] < end:
            cursors.append([p.parts[k], k, p])
    while cursors:
        cursors.sort(key=lambda c: c[0])
        total, pivot = 0.0, -1
        for i, c in enumerate(cursors):
            total += c[2].top
            if total >= slack:
                pivot = i
                break
        if pivot < 0:
            break
        part = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == part:
            pivot += 1
        # the blocks in which the pivot lies (without reading the postings)
        total, stop = 0.0, end
        for c in cursors[: pivot + 1]:
            p = c[2]
            b = c[1] // block
            while b < len(p.block_last) and p.block_last[b] < part:
                b += 1
            if b < len(p.block_last):
                total += p.block_max[b]
                stop = min(stop, p.block_last[b] + 1)
        if pivot + 1 < len(cursors):
            stop = min(stop, cursors[pivot + 1][0])
        if total < slack:
            target = max(stop, part + 1)
            moved = cursors[: pivot + 1]
        elif cursors[0][0] == part:
            score = sum(c[2].weights[c[1]] for c in cursors[: pivot + 1])
            if score >= slack:
                found.append((part, score))
            target, moved = part + 1, cursors[: pivot + 1]
        else:
            target, moved = part, [c for c in cursors[: pivot + 1] if c[0] < part]
        for c in moved:
            p = c[2]
            c[1] = _seek(p, c[1], target, block)
            c[0] = p.parts[c[1]] if c[1] < len(p.parts) else end
        cursors = [c for c in cursors if c[0] < end]
    return found


def _seek(p: Posting, k: int, part: int, block: int) -> int:
    """Position of the first posting from k on with at least this part, by whole blocks first."""
    b = k // block
    while b < len(p.block_last) and p.block_last[b] < part:
        b += 1
    k = max(k, b * block)
    while k < len(p.parts) and p.parts[k] < part:
        k += 1
    return k


def search_texts(index: Index, texts: list[str]) -> Iterator[tuple[int, int, float, float, float, int]]:
    """(text, item, score, question overlap, answer overlap, first word of the passage) of
    the items that each text contains; an item once per text, by its best passage."""
    if not len(index.vocabulary):
        return
    p, w = index.p, words_of(texts)
    if not len(w.hash):
        return
    term = np.searchsorted(index.vocabulary, w.hash)
    term[term == len(index.vocabulary)] = 0
    known = index.vocabulary[term] == w.hash
    # half passages: part_words words of one text
    n = np.diff(w.first)
    halves = np.maximum(1, -(-n // p.part_words))
    first_half = np.concatenate(([0], np.cumsum(halves)))
    doc = np.repeat(np.arange(len(texts)), n)
    half = first_half[doc] + (np.arange(len(w.hash)) - w.first[doc]) // p.part_words
    pairs = np.unique(half[known] * np.int64(len(index.vocabulary)) + term[known])
    half_of, term_of = pairs // len(index.vocabulary), pairs % len(index.vocabulary)
    cut = np.searchsorted(half_of, np.arange(first_half[-1] + 1))
    bound = np.zeros((int(first_half[-1]) + 1, index.n_ranges), np.float32)
    full = np.flatnonzero(np.diff(cut) > 0)
    if not len(full):
        return
    for a in range(0, len(full), 2048):  # bounded temporary arrays
        some = full[a : a + 2048]
        lo, hi = cut[some[0]], cut[some[-1] + 1]
        bound[some] = np.add.reduceat(index.bound[term_of[lo:hi]], cut[some] - lo, axis=0)
    follows = np.ones(len(bound), bool)  # a half has a next half of the same text
    follows[first_half[1:] - 1] = False
    both = bound[:-1] + np.where(follows[:-1, None], bound[1:], 0)
    best: dict[tuple[int, int], tuple[float, float, float, int]] = {}  # passages that hold the item
    checked: dict[tuple[int, int, int], tuple[float, float]] = {}
    for k, r in zip(*np.nonzero(both >= p.theta - 1e-4), strict=True):
        d = int(np.searchsorted(first_half, k, side="right") - 1)
        terms = np.unique(term_of[cut[k] : cut[k + 2 if follows[k] else k + 1]]).tolist()
        at = int(k - first_half[d]) * p.part_words
        for part, score in index.search(terms, int(index.range_first[r]), int(index.range_first[r + 1])):
            item = index.part_item[part]
            old = best.get((d, item))
            if old is not None and score <= old[0]:
                continue  # an item already found, by a better passage
            got = checked.get((d, item, at))
            if got is None:
                got = checked[d, item, at] = _overlap(index, item, w, d, at)
            if min(got) >= p.overlap:
                best[d, item] = (score, *got, at)
    for (d, item), (score, q, a, at) in best.items():
        yield d, item, score, q, a, at


def _overlap(index: Index, item: int, w: Words, d: int, at: int) -> tuple[float, float]:
    """Shares of the item's question and answer shingles around the passage."""
    n = index.lengths[item]
    lo = w.first[d] + max(0, at - n)
    hi = min(w.first[d + 1], w.first[d] + at + 2 * index.p.part_words + n)
    got = [float(np.isin(s, runs(w.hash[lo:hi], size)).mean()) for size, s in index.shingles[item]]
    return got[0], got[1] if len(got) > 1 else 1.0


def slices(benchmark: DataFrame, p: Params, id_col: str = "item_id", text_col: str = "text") -> Iterator[Index]:
    """Indexes of the benchmark, one per bounded slice of its items."""
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    items = items.distinct()
    n = -(-items.count() // p.slice_items)
    if n == 1:
        yield Index(_collected(items), p)
        return
    bags = hold(_part_words(items, p), "benchmark-words") if n else None
    of_parts = bags.where("word IS NULL").agg(F.count("*").alias("n"), F.sum("length").alias("length")).first() if n else None
    counts = hold(bags.where("word IS NOT NULL").groupBy("word").agg(F.count("*").alias("n")), "benchmark-counts") if n else None
    for k in range(n):
        mine = F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k
        words = bags.where((F.pmod("slice", F.lit(n)) == k) & F.col("word").isNotNull()).select("word").distinct()
        rows = counts.join(words, "word").toPandas()  # the words of one slice
        words = rows["word"].to_numpy(np.int64).view(U)
        order = np.argsort(words)
        of_all = Statistics(of_parts.n, max(of_parts.length / max(of_parts.n, 1), 1e-9), words[order], rows["n"].to_numpy()[order])
        yield Index(_collected(items.where(mine)), p, of_all)


def _collected(items: DataFrame) -> list[tuple[int | None, str]]:
    return sorted(((r.item_id, r.text) for r in items.collect()), key=lambda x: (x[0] is None, x))


def _part_words(items: DataFrame, p: Params) -> DataFrame:
    """(slice, word, length): a row for each distinct word of each part, and one with the
    part's length and no word. `slice` is the item's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for words, n in part_bags(words_of(list(split_item(text))).hash, p):
                    word = pa.concat_arrays([pa.array(words.view(np.int64)), pa.nulls(1, pa.int64())])
                    length = pa.concat_arrays([pa.nulls(len(words), pa.int64()), pa.array([int(n.sum())])])
                    yield pa.RecordBatch.from_arrays([pa.array([own] * len(word), pa.int64()), word, length], names=["slice", "word", "length"])

    keyed = items.select(F.xxhash64("item_id", "text").alias("slice"), "text")
    return keyed.mapInArrow(run, "slice long, word long, length long")


SCHEMA = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, word_start long"


def find_contamination(df: DataFrame, benchmark: DataFrame, p: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for every (document, test item that it contains)."""
    docs = id_text(df, id_col, text_col)
    out = None
    for index in slices(benchmark, p):
        part = docs.mapInArrow(_finder(index), SCHEMA)
        out = part if out is None else out.unionAll(part)
    return out if out is not None else df.sparkSession.createDataFrame([], SCHEMA)


def _finder(index: Index) -> Callable:
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = [
                (ids[a + d], index.ids[item], score, q, s, at)
                for a, b in chunks(texts)
                for d, item, score, q, s, at in search_texts(index, texts[a:b])
            ]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return run


def drop_contaminated(df: DataFrame, benchmark: DataFrame, p: Params = Params(), text_col: str = "text") -> DataFrame:
    """The rows of `df`, all columns, that contain no test item (each row judged by itself,
    in one pass and without a shuffle)."""
    from liftwise.llm.common import keep_rows

    for index in slices(benchmark, p):

        def clean(texts: list[str], index: Index = index) -> np.ndarray:
            ok = np.ones(len(texts), bool)
            for d, *_ in search_texts(index, texts):
                ok[d] = False
            return ok

        df = keep_rows(df, text_col, clean)
    return df
