"""N-gram Jaccard join: all pairs of documents whose sets of five-word shingles have a Jaccard
similarity of 0.8 or more, as class and number of links per document.

1. Documents of equal word sequences are one text, represented by their smallest id.
2. Each text gets 160 MinHash values. Texts that agree on one of 32 bands of 5 values are
   linked to the band's smallest text (links grow with the rows, not with a bucket's square);
   the connected components of these links are the candidate clusters. A pair at 0.8 agrees
   on some band with probability 0.999997.
3. Within a cluster, cut into blocks so that a task holds two blocks at most, pairs are
   compared by MinHash values 32 at a time. Given m agreements of n, the similarity has a
   beta posterior (uniform prior); pairs whose posterior probability of reaching the
   threshold is below `tolerance` are dropped, the others verified exactly on their shingle
   sets. Pairs are counted and united in the task; only each text's number of links and a
   spanning forest of the links leave it.
4. Components of the forests are the classes.

Defined results: texts of fewer than five words have one shingle, all of their words; texts
without words (null and empty ones too) are copies of each other; repeated rows are copies of
each other; rows with a null id have no class (null) and no links; an empty table gives no
rows. n_links counts the other rows linked to a row, copies included.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftwise.llm.common import hold, id_text, stream_groups
from liftwise.llm.components import components
from liftwise.llm.words import SHINGLE, Words, chunks, mix, shingles_of, words_of

U = np.uint64
NO_VALUE = np.uint32(0xFFFFFFFF)


@dataclass(frozen=True)
class Params:
    threshold: float = 0.8
    bands: int = 32
    rows: int = 5
    step: int = 32  # MinHash values compared at a time
    tolerance: float = 1e-6
    block: int = 512

    @property
    def values(self) -> int:
        return self.bands * self.rows


def all_shingles(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes of all texts, index of each text's first)."""
    n = np.diff(w.first)
    if len(n) and n.min() >= SHINGLE:
        h = w.hash
        out = np.zeros(max(0, len(h) - SHINGLE + 1), U)
        for j in range(SHINGLE):
            out = out * U(0xD6E8FEB86659FD93) + h[j : j + len(out)]
        out = mix(out + U(SHINGLE))
        keep = np.ones(len(out), bool)
        for k in range(1, SHINGLE):
            keep[w.first[1:-1] - k] = False
        return out[keep], np.concatenate(([0], np.cumsum(n - SHINGLE + 1)))
    each = [shingles_of(w, d) for d in range(len(n))]
    return np.concatenate([*each, np.zeros(0, U)]), np.concatenate(([0], np.cumsum([len(s) for s in each]))).astype(np.int64)


@functools.cache
def _factors(n: int) -> tuple[np.ndarray, np.ndarray]:
    r = mix(np.arange(1, 2 * n + 1, dtype=U) * U(0x9E3779B97F4A7C15)).astype(np.uint32) | np.uint32(1)
    return r[:n], r[n:]


def minhash(shingles: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """(texts, n) MinHash values; all ones for a text without shingles."""
    out = np.full((len(first) - 1, n), NO_VALUE)
    full = np.flatnonzero(np.diff(first) > 0)
    if len(full):
        lo, hi = shingles.astype(np.uint32), (shingles >> U(32)).astype(np.uint32)
        a, b = _factors(n)
        for k in range(n):
            out[full, k] = np.minimum.reduceat(lo * a[k] + hi * b[k], first[full])
    return out


def text_keys(w: Words) -> np.ndarray:
    """(texts, 2) 128-bit keys of the texts' word sequences."""
    at = np.arange(len(w.hash), dtype=U) - np.repeat(w.first[:-1], np.diff(w.first)).astype(U)
    out = np.zeros((len(w.first) - 1, 2), U)
    full = np.flatnonzero(np.diff(w.first) > 0)
    for k, salt in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
        v = mix(w.hash + mix(at + U(salt)))
        if len(full):
            out[full, k] = mix(np.add.reduceat(v, w.first[full]) + U(k + 1))
    return out


def _signatures(df: DataFrame, p: Params) -> DataFrame:
    """(doc_id, text_hash, k1, k2, sig): sig is None for a text without shingles."""
    docs = id_text(df).where("doc_id IS NOT NULL").select("doc_id", F.xxhash64("text").alias("text_hash"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for a, b in chunks(texts):
                w = words_of(texts[a:b])
                key = text_keys(w).view(np.int64)
                sig = minhash(*all_shingles(w), p.values)
                raw = [s.tobytes() if n else None for s, n in zip(sig, np.diff(w.first), strict=True)]
                cols = [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(key[:, 0]), pa.array(key[:, 1]), pa.array(raw, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "text_hash", "k1", "k2", "sig"])

    return docs.mapInArrow(run, "doc_id long, text_hash long, k1 long, k2 long, sig binary")


def _bands(texts: DataFrame, p: Params) -> DataFrame:
    """(rep, band_hash) of every band of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rep = b.column(0).to_numpy()
            if not len(rep):
                continue
            sig = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).reshape(len(rep), p.bands, p.rows).astype(U)
            h = np.broadcast_to(np.arange(1, p.bands + 1, dtype=U), (len(rep), p.bands)).copy()
            for r in range(p.rows):
                h = mix(h * U(0x9E3779B97F4A7C15) + sig[:, :, r])
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(rep, p.bands)), pa.array(h.ravel().view(np.int64))], names=["rep", "band"])

    return texts.where("sig IS NOT NULL").select("rep", "sig").mapInArrow(run, "rep long, band long")


@functools.cache
def least_agreements(n: int, threshold: float, tolerance: float) -> int:
    """The smallest m for which P(similarity >= threshold | m of n agree) >= tolerance."""
    s = (np.arange(20_000) + 0.5) / 20_000
    for m in range(n + 1):
        logs = m * np.log(s) + (n - m) * np.log1p(-s)
        dens = np.exp(logs - logs.max())
        if dens[s >= threshold].sum() / dens.sum() >= tolerance:
            return m
    return n


def surviving_pairs(a: np.ndarray, b: np.ndarray | None, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of signatures of a and b (or i < j within a) that Bayesian pruning keeps."""
    other = a if b is None else b
    n = p.step
    same = np.zeros((len(a), len(other)), np.int16)
    for k in range(n):
        same += a[:, k, None] == other[None, :, k]
    ok = same >= least_agreements(n, p.threshold, p.tolerance)
    i, j = np.nonzero(np.triu(ok, 1) if b is None else ok)
    count = same[i, j].astype(np.int64)
    while n < p.values and len(i):
        m = min(n + p.step, p.values)
        for at in range(0, len(i), 1 << 16):
            s = slice(at, at + (1 << 16))
            count[s] += (a[i[s], n:m] == other[j[s], n:m]).sum(axis=1)
        n = m
        keep = count >= least_agreements(n, p.threshold, p.tolerance)
        i, j, count = i[keep], j[keep], count[keep]
    return i, j


def linked_pairs(i: np.ndarray, j: np.ndarray, sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which of the pairs of shingle sets reach the threshold: exact, a set at a time."""
    used = np.unique(np.concatenate((i, j)))
    ids, inv = np.unique(np.concatenate([sets[k] for k in used] or [np.zeros(0, U)]), return_inverse=True)
    cut = np.cumsum([0] + [len(sets[k]) for k in used])
    local = {int(k): inv[s:e] for k, s, e in zip(used, cut, cut[1:], strict=False)}
    mark = np.zeros(len(ids), bool)
    out = np.zeros(len(i), bool)
    for a in np.unique(i).tolist():
        mark[local[a]] = True
        for k in np.flatnonzero(i == a).tolist() if len(i) < 64 else range(*np.searchsorted(i, (a, a + 1)).tolist()):
            x = local[int(j[k])]
            common = int(mark[x].sum())
            out[k] = common >= threshold * (len(x) + len(local[a]) - common) - 1e-9
        mark[local[a]] = False
    return out


def _verify(p: Params):
    def run(t: pa.Table) -> Iterator[pa.RecordBatch]:
        rep, place = np.unique(t.column("rep").to_numpy(), return_index=True)  # a repeated row once
        t = t.take(pa.array(place))
        mult, blk = t.column("mult").to_numpy(), t.column("block").to_numpy()
        sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint32).reshape(len(rep), -1)
        bi, bj = t.column("bi")[0].as_py(), t.column("bj")[0].as_py()
        if bi == bj:
            i, j = surviving_pairs(sig, None, p)
        else:
            left, right = np.flatnonzero(blk == bi), np.flatnonzero(blk == bj)
            i, j = surviving_pairs(sig[left], sig[right], p)
            i, j = left[i], right[j]
        if not len(i):
            return
        order = np.lexsort((j, i))
        i, j = i[order], j[order]
        used = np.unique(np.concatenate((i, j)))
        texts = t.column("text").take(pa.array(used)).to_pylist()
        sets: list[np.ndarray] = [np.zeros(0, U)] * len(rep)
        for a, b in chunks(texts):
            w = words_of(texts[a:b])
            for d in range(b - a):
                sets[used[a + d]] = np.unique(shingles_of(w, d))
        ok = linked_pairs(i, j, sets, p.threshold)
        i, j = i[ok], j[ok]
        links = np.bincount(i, mult[j], len(rep)) + np.bincount(j, mult[i], len(rep))
        rows = [(0, int(rep[k]), int(links[k])) for k in np.flatnonzero(links)]
        root = list(range(len(rep)))

        def find(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            x, y = find(a), find(b)
            if x != y:
                root[max(x, y)] = min(x, y)
                rows.append((1, int(rep[a]), int(rep[b])))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["kind", "a", "b"])

    return run


def near_duplicates(df: DataFrame, p: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id, n_links, n_copies) of every row: the smallest id of its class, the
    number of other rows linked to it, and the number of rows with its very words."""
    docs = id_text(df, id_col, text_col)
    sigs = hold(_signatures(docs, p), "signatures")
    texts = hold(
        sigs.groupBy("k1", "k2")
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("r"), F.count("*").alias("mult"), F.first("sig").alias("sig"))
        .select("k1", "k2", F.col("r.doc_id").alias("rep"), F.col("r.text_hash").alias("text_hash"), "mult", "sig"),
        "texts",
    )
    bands = hold(_bands(texts, p), "bands")
    buckets = bands.groupBy("band").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi")
    links = bands.join(hold(buckets.select("band", "lo"), "buckets"), "band").where("rep <> lo")
    cluster = hold(components(links, "rep", "lo", "candidates"), "clusters")
    n_blocks = F.ceil(F.count("*") / F.lit(p.block)).cast("int").alias("n_blocks")
    sizes = hold(cluster.groupBy("root").agg(n_blocks), "cluster-sizes")
    block = F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int").alias("block")
    placed = cluster.join(sizes, "root").select("root", F.col("node").alias("rep"), "n_blocks", block)
    known = placed.join(texts.select("rep", "text_hash", "mult", "sig"), "rep")
    body = docs.withColumn("text_hash", F.xxhash64("text")).withColumnRenamed("doc_id", "rep")
    full = known.join(body, ["rep", "text_hash"])
    other = full.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    tasks = other.select("root", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"), "block", "rep", "mult", "sig", "text")
    found = hold(stream_groups(tasks, ["root", "bi", "bj"], _verify(p), "kind int, a long, b long"), "links")
    n_links = hold(found.where("kind = 0").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("n")), "link-counts")
    classes = hold(components(found.where("kind = 1"), "a", "b", "classes"), "classes")
    named = (
        texts.select("k1", "k2", "rep", "mult")
        .join(n_links, "rep", "left")
        .join(classes.withColumnRenamed("node", "rep"), "rep", "left")
        .select("k1", "k2", F.coalesce("root", "rep").alias("class_id"), (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.col("mult").alias("n_copies"))
    )
    out = sigs.select("doc_id", "k1", "k2").join(hold(named, "named"), ["k1", "k2"]).select("doc_id", "class_id", "n_links", "n_copies")
    loose = docs.where("doc_id IS NULL").select("doc_id", F.lit(None).cast("long").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("n_copies"))
    return out.unionAll(loose)


def drop_near_duplicates(df: DataFrame, p: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`df` with one document of each class, that of the smallest id; rows of equal ids stay or
    go together, rows with a null id stay."""
    gone = near_duplicates(df, p, id_col, text_col).where("doc_id <> class_id").select(F.col("doc_id").alias(id_col))
    return df.join(gone.distinct(), id_col, "left_anti").select(*[f"`{c}`" for c in df.columns])


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s AS a JOIN s AS b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM common JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9
  UNION
  SELECT x.doc_id, y.doc_id FROM w AS x JOIN w AS y ON x.w = y.w AND x.doc_id <> y.doc_id
), reach AS (
  SELECT doc_id, doc_id AS r FROM w
  UNION
  SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.r
)
SELECT w.doc_id, min(reach.r) AS class_id,
       (SELECT count(*) FROM link WHERE link.a = w.doc_id) AS n_links,
       (SELECT count(*) FROM w AS v WHERE v.w = w.w) AS n_copies
FROM w JOIN reach ON reach.doc_id = w.doc_id GROUP BY w.doc_id, w.w
"""
