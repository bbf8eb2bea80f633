"""Exact top-k search by integer inner product: M-trees, searched best-first.

Metric. With M the largest norm of all vectors, x is placed at (x, sqrt(M^2 - |x|^2)) and a
query at (q, 0); their squared distance is |q|^2 + M^2 - 2 q.x, so the nearest neighbours are
the vectors of the largest inner products. Distances prune, with a margin for rounding; the
scores that rank are integers, computed exactly.

Tree. Nodes are pages of entries. An inner entry has a routing object, its covering radius
and its distance to the node's own routing object (the parent distance); a leaf entry is a
vector with its parent distance, by which a leaf is sorted. Up to `together` queries are
searched at once: the node of the smallest possible distance to any of them comes first, with
those that it can still give a better row. In a page, entries with
|d(q, parent) - parent distance| - radius beyond the k-th best distance of each query are
passed over without computing their distance. The others' scores are one matrix product, in
the narrowest type that holds every sum exactly; where most queries need most leaves of a
page, those leaves are one product.

On Spark. Vectors are assigned to the nearest of a bounded number of pivots; each cell is cut
into blocks of about `block_rows` vectors by a hash of the id, so a cell with a third of all
vectors is many blocks. Each block is sent once; its task builds the tree and searches it for
the queries as they stream past, many in a row of bytes. Queries skip cells that the k-th best
score in a bounded sample of the vectors rules out. Per query the blocks' results (k rows each
at most, none below that score) are ranked. No vector is left out anywhere. Where nothing can be
ruled out, as among random directions, the work is the product of queries and vectors.

Defined results: null vectors, and those with a null or non-finite component, take no part;
nor do rows with a null id; queries meet vectors of their own dimension only; components
and scores are exact 64-bit integers, and beyond that range the nearest one; repeated ids
are candidates each, but never of a query of that id; ties go to the smaller id; empty
tables give no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from liftwise.llm.common import discard, hold, rows_per_batch, tasks

LIMIT = (1 << 63) - 1
SAFE = 2.0**62
NONE = np.iinfo(np.int64).min  # no score yet
PACK_BYTES = 1 << 16  # of queries in a row
PACKS = 1024  # rows in an Arrow batch of packed queries


def inner(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of x and of y, exact; beyond 64 bits the nearest
    64-bit number. int64 sums wrap, so they are right wherever the result is in range."""
    s = x @ y.T
    for i, j in np.argwhere(np.abs(x.astype(np.float64) @ y.T.astype(np.float64)) >= SAFE):
        exact = sum(a * b for a, b in zip(x[i].tolist(), y[j].tolist(), strict=True))
        s[i, j] = min(max(exact, -LIMIT), LIMIT)
    return s


def score_type(top: float) -> type:
    """A type in which inner products of integer vectors are exact, partial sums too; `top` is
    the square of the largest norm, so none of them exceeds it."""
    return np.float32 if top < 2.0**23 else np.float64 if top < 2.0**52 else np.int64


def scores(x: np.ndarray, y: np.ndarray, top: float) -> np.ndarray:
    """`inner` of rows that have the type of `score_type`, in that type."""
    return inner(x, y) if top >= SAFE else x @ y.T


@dataclass(frozen=True)
class Params:
    k: int = 5
    scale: int = 256
    leaf: int = 96
    fanout: int = 24
    cells: int = 64
    sample: int = 1024
    block_rows: int = 16_384
    query_rows: int = 16_384  # held with a tree
    together: int = 2048  # of them searched at once


@dataclass
class Node:
    entry: np.ndarray  # positions of the entries' vectors
    parent_dist: np.ndarray
    radius: np.ndarray  # 0 in leaves
    child: list[Node] | None  # None in leaves
    leaf_rows: np.ndarray | None = None  # of each child, 0 if it is no leaf


class MTree:
    """`x` integer vectors (rows), `ids` theirs; `top` the square of the largest norm."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, top: float, p: Params):
        self.p, self.x, self.ids = p, x, ids
        self.f = x.astype(np.float64)
        self.rows = x.astype(score_type(top))
        self.extra = np.sqrt(np.maximum(top - (self.f**2).sum(axis=1), 0))
        self.top = top
        self.root_object = 0
        self.root, self.root_radius = self._build(np.arange(len(x)), 0)
        self.computed = 0

    def _dist(self, a: int, idx: np.ndarray, f: np.ndarray | None = None) -> np.ndarray:
        """From the vector a to those of idx, f."""
        d = (self.f[idx] if f is None else f) - self.f[a]
        return np.sqrt(np.einsum("ij,ij->i", d, d) + (self.extra[idx] - self.extra[a]) ** 2)

    def _build(self, idx: np.ndarray, routing: int) -> tuple[Node, float]:
        """A node over the vectors idx below the routing object, and its covering radius."""
        d = self._dist(routing, idx)
        if len(idx) <= self.p.leaf:
            order = d.argsort(kind="stable")
            return Node(idx[order], d[order], np.zeros(len(idx)), None), float(d.max(initial=0))
        groups = self._split(idx, d)
        entries, nodes, radii = [], [], []
        for seed, members in groups:
            node, r = self._build(members, seed)
            entries.append(seed)
            nodes.append(node)
            radii.append(r)
        e = np.array(entries)
        rows = np.array([len(x.entry) if x.child is None else 0 for x in nodes])
        return Node(e, self._dist(routing, e), np.array(radii), nodes, rows), float(d.max())

    def _split(self, idx: np.ndarray, d: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """Seeds far from each other, no more than fill leaves; each vector goes to the nearest.
        If all vectors are equal, even runs."""
        seeds, near = [int(idx[d.argmax()])], None
        owner, f = np.zeros(len(idx), np.int64), self.f[idx]
        fanout = max(4, min(self.p.fanout, -(-len(idx) // self.p.leaf)))
        for k in range(fanout):
            away = self._dist(seeds[k], idx, f)
            if near is None:
                near = away
            else:
                owner[away < near] = k
                near = np.minimum(near, away)
            far = int(near.argmax())
            if near[far] <= 0 or k + 1 == fanout:
                break
            seeds.append(int(idx[far]))
        if len(seeds) == 1:
            return [(int(part[0]), part) for part in np.array_split(idx, self.p.fanout) if len(part)]
        return [(s, m) for k, s in enumerate(seeds) if len(m := idx[owner == k])]

    def search(self, q: np.ndarray, own: int, bound: int | None) -> list[tuple[int, int]]:
        """The k best (score, id), own id left out; `bound` is a score that the k-th best of
        all vectors reaches at least."""
        _, score, i = self.search_many(q[None], np.array([own]), np.array([NONE if bound is None else bound]))
        return list(zip(score.tolist(), i.tolist(), strict=True))

    def search_many(self, q: np.ndarray, own: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of q, score, id) of the k best of each row, in this order, best first; own ids
        and scores below the bound (NONE: no bound) are left out."""
        qf = q.astype(np.float64)
        q2 = (qf * qf).sum(axis=1)
        top = max(self.top, float(q2.max(initial=0)))
        kind = score_type(top)
        asked, rows = q.astype(kind), self.rows.astype(kind, copy=False)
        qq = q2 + self.top
        slack = 1e-7 * (1 + qq)
        best = Best(self.ids, bound, self.p.k, kind, lambda score, i: np.sqrt(np.maximum(qq[i] - 2.0 * score, 0) + slack[i]) + slack[i])
        every = np.arange(len(q))

        def distances(of: np.ndarray, e: np.ndarray) -> np.ndarray:
            self.computed += len(e) * len(of)
            return np.sqrt(np.maximum(qq[of, None] - 2 * (qf[of] @ self.f[e].T), 0))

        def leaf(of: np.ndarray, e: np.ndarray) -> None:
            self.computed += len(e) * len(of)
            score = scores(asked[of] if len(of) < len(q) else asked, rows[e], top)
            i, j = best.passing(of, score)
            other = self.ids[e[j]] != own[of[i]]
            best.take(of[i[other]], e[j[other]], score[i[other], j[other]])

        d0 = distances(every, np.array([self.root_object]))[:, 0]
        low = np.maximum(d0 - self.root_radius, 0)
        heap = [(float(low.min(initial=0)), 0, every, d0, low, self.root)]
        n = 1
        while heap:
            first, _, of, dq, low, node = heapq.heappop(heap)
            if first > best.limit.max(initial=0):
                break
            use = low <= best.limit[of]
            of, dq = of[use], dq[use]
            limit = best.limit[of]
            if node.child is None:
                near = (dq - limit <= node.parent_dist[-1]) & (dq + limit >= node.parent_dist[0])
                of, dq, limit = of[near], dq[near], limit[near]
                if not len(of):
                    continue
                # sorted by parent distance: one slice holds what any of them needs
                a, b = np.searchsorted(node.parent_dist, (dq - limit).min()), np.searchsorted(node.parent_dist, (dq + limit).max(), "right")
                if a < b:
                    leaf(of, node.entry[a:b])
                continue
            page = np.flatnonzero((np.abs(dq[:, None] - node.parent_dist) - node.radius <= limit[:, None]).any(axis=0))
            e = node.entry[page]
            d = distances(of, e)
            lows = np.maximum(d - node.radius[page], 0)
            open_ = lows <= limit[:, None]
            n_rows = node.leaf_rows[page]
            if 2 * np.count_nonzero(open_, axis=0) @ n_rows > len(of) * n_rows.sum() > 0:
                # most queries need most of the leaves below: one product of all of them
                each = np.flatnonzero((n_rows > 0) & open_.any(axis=0))
                some = open_[:, each].any(axis=1)
                leaf(of[some], np.concatenate([node.child[k].entry for k in page[each].tolist()]))
                open_ &= n_rows == 0
            for j, k in enumerate(page.tolist()):
                some = np.flatnonzero(open_[:, j])
                if len(some):
                    heapq.heappush(heap, (float(lows[some, j].min()), n, of[some], d[some, j], lows[some, j], node.child[k]))
                    n += 1
        return best.found()


class Best:
    """The k best rows of each query so far, the least score that can still be among them, and
    the farthest distance of such a row."""

    def __init__(self, ids: np.ndarray, bound: np.ndarray, k: int, kind: type, reach):
        self.ids, self.k, self.reach = ids, k, reach
        self.place = np.empty(len(ids), np.int64)  # ties go to the smaller id
        self.place[np.argsort(ids, kind="stable")] = np.arange(len(ids))
        known = bound > NONE
        self.least = np.where(known, bound, NONE if kind is np.int64 else -np.inf).astype(kind)
        self.limit = np.full(len(bound), np.inf)
        self.limit[known] = reach(bound[known], known)
        self.of, self.score, self.entry = (np.zeros(0, np.int64) for _ in range(3))
        self.new: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n_new = 0

    def passing(self, of: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the scores of the queries `of` (rows) are not too low."""
        rows = np.flatnonzero(score.max(axis=1) >= self.least[of])
        i, j = np.nonzero(score[rows] >= self.least[of[rows], None])
        return rows[i], j

    def take(self, of: np.ndarray, entry: np.ndarray, score: np.ndarray) -> None:
        self.new.append((of, score.astype(np.int64), entry))
        self.n_new += len(of)
        if self.n_new > 4 * self.k * len(self.limit):
            self.settle()

    def settle(self) -> None:
        of, score, entry = (np.concatenate(c) for c in zip((self.of, self.score, self.entry), *self.new, strict=True))
        self.new, self.n_new = [], 0
        order = np.lexsort((self.place[entry], -score, of))
        of = of[order]
        begin = np.searchsorted(of, of)
        keep = np.arange(len(of)) - begin < self.k
        self.of, self.score, self.entry = of[keep], score[order[keep]], entry[order[keep]]
        last = np.flatnonzero(np.arange(len(of)) - begin == self.k - 1)
        full, kth = of[last], score[order[last]]
        self.least[full] = kth  # no less than before: no row below it was taken
        self.limit[full] = np.minimum(self.limit[full], self.reach(kth, full))

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.settle()
        return self.of, self.score, self.ids[self.entry]


def distinct_best(x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of equal vectors up to k rows of each of the k + 1 smallest ids: no other can be among a
    query's k best, whichever id is its own."""
    mixed = x.astype(np.int64) @ np.random.default_rng(0).integers(1 << 62, size=x.shape[1])
    order = np.lexsort((ids, mixed))
    new = (x[order[1:]] != x[order[:-1]]).any(axis=1)
    if (new & (np.diff(mixed[order]) == 0)).any():  # unequal vectors may lie among equal ones
        order = np.lexsort((ids, *x.T[::-1]))
        new = (x[order[1:]] != x[order[:-1]]).any(axis=1)
    x, ids, new = x[order], ids[order], np.concatenate((np.ones(min(1, len(order)), bool), new))
    other = new.copy()
    other[1:] |= ids[1:] != ids[:-1]
    n_ids, start = np.cumsum(other), np.flatnonzero(other)
    place = np.arange(len(x)) - start[n_ids - 1]
    keep = (n_ids - n_ids[np.flatnonzero(new)][np.cumsum(new) - 1] <= k) & (place < k)
    return x[keep], ids[keep]


# ---------------------------------------------------------------- Spark


def _binary(x: np.ndarray) -> pa.Array:
    """The rows of x as bytes."""
    x = np.ascontiguousarray(x)
    offsets = np.arange(len(x) + 1, dtype=np.int64) * x.shape[1] * x.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(x), [None, pa.py_buffer(offsets), pa.py_buffer(x)]).cast(pa.binary())


def _matrix(col: pa.Array | pa.ChunkedArray, dim: int, kind: str = "<i8") -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), kind).reshape(-1, dim)


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, p: Params) -> DataFrame:
    """(vec_id, dim, v): floor(scale * x) of whole, finite vectors as little-endian int64."""
    kind = df.select(vec_col).dtypes[0][1]
    x = F.col(vec_col).cast(kind if kind == "array<float>" else "array<double>")
    src = df.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))
    src = src.where("vec_id IS NOT NULL AND x IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, lists = b.column(0).to_numpy(zero_copy_only=False), b.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # a null is NaN
            n = lists.value_lengths().to_numpy(zero_copy_only=False)
            first = np.cumsum(n) - n
            for dim in np.unique(n[n > 0]).tolist():
                of = np.flatnonzero(n == dim)
                x = flat[first[of][:, None] + np.arange(dim)] if len(of) < len(n) else flat.reshape(-1, dim)
                whole = np.isfinite(x).all(axis=1)
                v = _integers(p.scale * x[whole])
                norm = (v.astype(np.float64) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(ids[of][whole]), pa.array(np.full(len(v), dim, np.int32)), _binary(v), pa.array(norm)], names=["vec_id", "dim", "v", "norm"])

    return src.mapInArrow(run, "vec_id long, dim int, v binary, norm double")


def _integers(v: np.ndarray) -> np.ndarray:
    """floor(v) as int64, held to its range."""
    v = np.floor(v)
    far = np.abs(v) >= 2.0**63
    out = np.where(far, 0, v).astype("<i8")
    return np.where(far, np.where(v > 0, LIMIT, -LIMIT), out).astype("<i8")


def width(top: float) -> str:
    """The narrowest integers that hold the components of vectors of at most this squared norm."""
    return "<i2" if top < 2.0**29 else "<i4" if top < 2.0**61 else "<i8"


def top_k(df: DataFrame, is_query: Column, p: Params = Params(), id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best of all other rows. `is_query` is a
    condition over vec_id."""
    spark = df.sparkSession
    schema = "query_id long, rank int, vec_id long, score long"
    vectors = hold(integer_vectors(df, id_col, vec_col, p), "vectors")
    parts = []
    for row in vectors.groupBy("dim").agg(F.max("norm").alias("top")).where("dim > 0").orderBy("dim").collect():
        parts.append(_top_k(vectors.where(F.col("dim") == row.dim), is_query, row.dim, row.top, p))
    discard([vectors])
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for x in parts[1:]:
        out = out.unionAll(x)
    return out


def _top_k(vectors: DataFrame, is_query: Column, dim: int, top: float, p: Params) -> DataFrame:
    spark = vectors.sparkSession
    drawn = vectors.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(p.sample).select("vec_id", "v").collect()
    sample_ids = np.array([r.vec_id for r in drawn])
    sample = np.stack([np.frombuffer(r.v, "<i8") for r in drawn])
    pivots = np.unique(sample[: p.cells], axis=0).astype(np.float64)
    kind = width(top)

    def place(x: np.ndarray) -> np.ndarray:
        f = x.astype(np.float64)
        return np.hstack((f, np.sqrt(np.maximum(top - (f**2).sum(axis=1), 0))[:, None]))

    centre = place(pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = _matrix(b.column(1), dim)
            x = place(v)
            d2 = (x**2).sum(axis=1)[:, None] + (centre**2).sum(axis=1)[None] - 2 * (x @ centre.T)
            cell = d2.argmin(axis=1)
            away = np.sqrt(((x - centre[cell]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([b.column(0), _binary(v.astype(kind)), pa.array(cell, pa.int32()), pa.array(away)], names=["vec_id", "v", "cell", "away"])

    placed = hold(vectors.select("vec_id", "v").mapInArrow(assign, "vec_id long, v binary, cell int, away double"), "cells")
    # at most p.cells rows
    cells = {r.cell: (r.n, r.r) for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("r")).collect()}
    blocks = {c: -(-n // p.block_rows) for c, (n, _) in cells.items()}
    radius = np.array([cells[c][1] if c in cells else -np.inf for c in range(len(centre))])
    pack = max(1, PACK_BYTES // (dim * np.dtype(kind).itemsize))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries to the blocks of the cells that may hold one of their k best, many in a row."""
        known = sample.astype(score_type(top))
        for b in batches:
            q, ids = _matrix(b.column(1), dim, kind), b.column(0).to_numpy()
            s = scores(q.astype(known.dtype), known, top).astype(np.int64)
            s[ids[:, None] == sample_ids[None]] = NONE
            kth = np.partition(s, -p.k, axis=1)[:, -p.k] if s.shape[1] > p.k else np.full(len(s), NONE)
            qf = q.astype(np.float64)
            qq = (qf**2).sum(axis=1) + top
            to_centre = np.sqrt(np.maximum(qq[:, None] - 2 * (qf @ centre[:, :-1].T), 0))
            slack = 1e-6 * (1 + qq)
            reach = np.where(kth > NONE, np.sqrt(np.maximum(qq - 2.0 * kth, 0) + slack), np.inf)
            rows = []
            for c in sorted(blocks):
                of = np.flatnonzero(to_centre[:, c] - radius[c] <= reach + slack)
                for part in (of[i : i + pack] for i in range(0, len(of), pack)):
                    rows += [(c, k, 1, None, ids[part].tobytes(), q[part].tobytes(), kth[part].tobytes()) for k in range(blocks[c])]
            for i in range(0, len(rows), PACKS):
                cols = zip(*rows[i : i + PACKS], strict=True)
                types = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, types, strict=True)], names=["cell", "block", "kind", "vec_id", "ids", "v", "bound"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per block its vectors come first, then the packs of queries; of a block only its tree
        and `query_rows` queries or one pack more are held."""
        tree, at = None, None
        held: list[tuple[np.ndarray, np.ndarray]] = []
        asked: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def answered() -> Iterator[pa.RecordBatch]:
            ids, q, bound = (np.concatenate(c) for c in zip(*asked, strict=True))
            asked.clear()
            for a in range(0, len(q), p.together):
                of, score, i = tree.search_many(q[a : a + p.together].astype(np.int64), ids[a : a + p.together], bound[a : a + p.together])
                if len(of):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[a + of], i, score)], names=["query_id", "vec_id", "score"])

        for b in batches:
            group = np.stack([b.column(c).to_numpy() for c in range(3)], 1)
            starts = np.flatnonzero(np.concatenate((np.ones(1, bool), (group[1:] != group[:-1]).any(axis=1))))[: len(group)]
            for i, j in zip(starts.tolist(), [*starts[1:].tolist(), len(group)], strict=True):
                if tuple(group[i, :2]) != at:
                    if asked:
                        yield from answered()
                    tree, at, held = None, tuple(group[i, :2]), []
                own, ids, v, bound = (b.column(c).slice(i, j - i) for c in range(3, 7))
                if group[i, 2] == 0:
                    held.append((own.to_numpy(), _matrix(v, dim, kind)))
                    continue
                if tree is None:
                    own, x = (np.concatenate(c) for c in zip(*held, strict=True))
                    x, own = distinct_best(x.astype(np.int64), own, p.k)
                    tree, held = MTree(x, own, top, p), []
                for row in zip(ids.to_pylist(), v.to_pylist(), bound.to_pylist(), strict=True):
                    some, q, least = (np.frombuffer(x, t) for x, t in zip(row, ("<i8", kind, "<i8"), strict=True))
                    asked.append((some, q.reshape(-1, dim), least))
                    if sum(len(x[0]) for x in asked) >= p.query_rows:
                        yield from answered()
        if asked:
            yield from answered()

    queries = placed.where(is_query).select("cell", "vec_id", "v")
    with rows_per_batch(spark, PACKS):
        # near each other in a pack
        n_packs = max(1, -(-queries.count() // PACKS))
        sorted_queries = queries.repartitionByRange(n_packs, "cell", "vec_id").sortWithinPartitions("cell", "vec_id")
        asked = sorted_queries.select("vec_id", "v").mapInArrow(route, "cell int, block int, kind int, vec_id long, ids binary, v binary, bound binary")
        n_blocks = F.get(F.array(*[F.lit(blocks.get(c, 1)) for c in range(len(centre))]), F.col("cell"))
        held = placed.select(
            "cell",
            F.pmod(F.xxhash64(F.lit("block"), "vec_id", "v"), n_blocks).cast("int").alias("block"),
            F.lit(0).alias("kind"),
            "vec_id",
            F.lit(None).cast("binary").alias("ids"),
            "v",
            F.lit(None).cast("binary").alias("bound"),
        )
        both = held.unionAll(asked).repartition(tasks(spark), "cell", "block").sortWithinPartitions("cell", "block", "kind")
        found = both.mapInArrow(search, "query_id long, vec_id long, score long")
        w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        ranked = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= p.k)
        out = hold(ranked.select("query_id", "rank", "vec_id", "score"), "top-k")
    discard([placed])
    return out


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
