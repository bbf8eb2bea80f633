"""Periodic runs of words, found by recursive frequency splitting, and their collapse.

Words are maximal runs of anything but ASCII white space. A run is a stretch of consecutive
words with smallest period q (words q apart are identical) of at least max(min_words,
min_exponent * q) words that no neighbouring word extends keeping period q. Collapsing keeps
the first q words of each run and drops every word that lies in some run after its first q.

Method. Every word of a qualifying run occurs in it min_exponent times at least, so a word
that is rarer than that within a segment (at first the document) is in no run, and splits the
segment there. Counting and splitting go on within the pieces until nothing changes; this
runs for all documents of a batch at once, in sorted arrays that shrink with every round. The
segments left are scanned lag by lag. A stretch of min_exponent * q words holds that many
multiples of q, so lag q first compares the words at multiples of q only, and compares all
words just around chains of equal ones; all lags of a segment cost about m log m.

Plan: one pass over the documents, no shuffle; memory is bounded by a chunk of texts (or one
text). A task that runs again gives the same rows.

Defined results: null and empty texts have no words, no runs and the empty collapsed text;
null ids stay null; repeated rows give a row each; an empty table gives no rows; only the id
and text columns are read, so others cannot clash.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftwise.llm.common import id_text
from liftwise.llm.words import chunks

Run = tuple[int, int, int]  # start, length, period


def split_by_frequency(ids: np.ndarray, first: np.ndarray, least_count: int, least_words: int) -> list[tuple[int, int]]:
    """Ranges of `ids` in which every id occurs `least_count` times at least, of at least
    `least_words` ids. Ranges start as the documents first[d]:first[d+1]."""
    at = np.arange(len(ids))
    seg = np.repeat(np.arange(len(first) - 1), np.diff(first))
    width = int(ids.max(initial=0)) + 1
    while len(at):
        _, inverse, n = np.unique(seg * width + ids[at], return_inverse=True, return_counts=True)
        often = n[inverse] >= least_count
        if often.all():
            break
        at, seg = at[often], seg[often]
        seg = np.cumsum((np.diff(at, prepend=-2) > 1) | (np.diff(seg, prepend=-1) != 0)) - 1
        long = np.bincount(seg)[seg] >= least_words if len(seg) else often[:0]
        at, seg = at[long], seg[long]
    edge = np.flatnonzero(np.diff(seg, prepend=-1, append=-1))
    ranges = [(int(at[a]), int(at[b - 1]) + 1) for a, b in zip(edge, edge[1:], strict=False)]
    return [(a, b) for a, b in ranges if b - a >= least_words]


def _stretches(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(mask, prepend=False, append=False))
    return edge[0::2], edge[1::2]


def lag_scan(w: np.ndarray, min_words: int, min_exponent: int) -> list[Run]:
    """All runs of one segment, by lags from the smallest."""
    m, e = len(w), min_exponent
    found: set[tuple[int, int]] = set()
    runs: list[Run] = []
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # period -> starts, ends
    for q in range(1, m // e + 1):
        grid = w[::q]
        same = grid[1:] == grid[:-1]
        chain = same[e - 2 :]
        for k in range(e - 2):
            chain = chain & same[k : k - e + 2]
        if not chain.any():
            continue
        lo, hi = _stretches(chain)
        hi = hi + e - 2  # the last grid point of each chain
        for p in [p for p in known if q % p == 0]:  # inside a run whose period divides q there is no other
            start, end = known[p]
            k = np.searchsorted(start, lo * q, "right") - 1
            new = (k < 0) | (hi * q >= end[k])
            lo, hi = lo[new], hi[new]
        got = []
        for a, b in zip(np.maximum((lo - 1) * q + 1, 0).tolist(), np.minimum(hi * q + 1, m - q).tolist(), strict=True):
            s, t = _stretches(w[a:b] == w[a + q : b + q])
            wide = t - s >= max((e - 1) * q, min_words - q)
            got += [(a + i, a + j + q) for i, j in zip(s[wide].tolist(), t[wide].tolist(), strict=True)]
        got = [x for x in got if x not in found]
        if got:
            found.update(got)
            runs += [(a, b - a, q) for a, b in got]
            known[q] = np.array([a for a, _ in got]), np.array([b for _, b in got])
    return runs


def find_runs(ids: np.ndarray, first: np.ndarray, min_words: int = 6, min_exponent: int = 4) -> dict[int, list[Run]]:
    """Document number -> its runs by start, then period (documents without runs are left out)."""
    out: dict[int, list[Run]] = {}
    for a, b in split_by_frequency(ids, first, min_exponent, min_words):
        runs = lag_scan(ids[a:b], min_words, min_exponent)
        if runs:
            d = int(np.searchsorted(first, a, "right")) - 1
            out.setdefault(d, []).extend((s + a - int(first[d]), n, q) for s, n, q in runs)
    return {d: sorted(runs, key=lambda r: (r[0], r[2])) for d, runs in out.items()}


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    keep = np.ones(len(words), bool)
    for s, n, q in runs:
        keep[s + q : s + n] = False
    return [words[i] for i in np.flatnonzero(keep)]


SCHEMA = "doc_id long, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def periodic_runs(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 6, min_exponent: int = 4
) -> DataFrame:
    """Per document: its number of words, its runs and the collapsed text (kept words joined by
    one space). `min_exponent` is at least 2."""
    if min_exponent < 2:
        raise ValueError("min_exponent must be 2 or more")
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def work(ids: pa.Array, texts: list[bytes]) -> pa.RecordBatch:
        words = [t.split() for t in texts]  # bytes.split takes exactly the six ASCII white-space bytes
        first = np.concatenate(([0], np.cumsum([len(x) for x in words], dtype=np.int64)))
        number: dict[bytes, int] = defaultdict(count().__next__)
        flat = np.fromiter((number[x] for ws in words for x in ws), np.int64, int(first[-1]))
        runs = find_runs(flat, first, min_words, min_exponent)
        kept = [b" ".join(collapse(ws, runs[d]) if d in runs else ws) for d, ws in enumerate(words)]
        spans = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs.get(d, ())] for d in range(len(words))]
        cols = [ids, pa.array(np.diff(first)), pa.array(spans, run_type), pa.array(kept, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.binary()).to_pylist()
            for a, b in chunks(texts):
                yield work(ids.slice(a, b - a), texts[a:b])

    return id_text(df, id_col, text_col).mapInArrow(run, SCHEMA)


def with_periodic_tails(df: DataFrame) -> DataFrame:
    """(doc_id, text) in which one document of ten, chosen by h = crc32(doc_id as text), ends in a
    periodic tail: with g = h div 10, n words and a = g % n, each word from number a on becomes
    word a + (i - a) % p, p = 1 + (n - a) div (3 + g % 8). The rows that op12 is defined on."""
    docs = id_text(df)
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", F.when(h % 10 == 0, F.expr("regexp_extract_all(text, '[^\\\\x20\\\\x09-\\\\x0D]+', 0)")).alias("w"), F.floor(h / 10).alias("g"))
    rows = rows.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    tail = F.expr("array_join(transform(sequence(0, n - 1), i -> get(w, if(i < a, i, a + (i - a) % p))), ' ')")
    return rows.select("doc_id", F.when(F.col("n") > 0, tail).otherwise(F.col("text")).alias("text"))


def largest_run(runs: Column) -> Column:
    """The run of the greatest length / period, compared exactly; the first of equal ones."""
    return F.reduce(runs, F.get(runs, F.lit(0)), lambda x, y: F.when(y["length"] * x["period"] > x["length"] * y["period"], y).otherwise(x))


def digest(df: DataFrame) -> DataFrame:
    """The result columns of op12 from those of `periodic_runs`."""
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    best = df.withColumn("best", largest_run(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
