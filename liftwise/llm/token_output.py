"""Packed token-id matrices: best-fit-decreasing packing into rows of fixed width.

Documents are tokenised, closed by an end id and, where longer than a row, split losslessly
into row-sized pieces and a rest. Within a pool, pieces are placed in order of decreasing
length into the fullest row that still has room. A segment tree over the remaining
capacities finds it: a node holds the number of open rows in its range of capacities, so the
smallest sufficient capacity is one descent. Rows that are nearly full are written; the
pieces of the others go to the next pool.

Output, one row per matrix row: `ids` (row_tokens little-endian unsigned 32-bit ids, padded
with `pad_id`), `cu_seqlens` (cumulative segment lengths from 0 to the tokens used),
`position_resets` (offsets at which the position ids begin again at 0: each segment, and the
padding), and the segments' `doc_ids` and `starts`. `unpack` restores the documents.

Each task packs its own rows as they stream by, in memory bounded by the pool. Defined
results: null text is the empty text (one end id); null ids stay null; repeated rows are
packed as often as they occur; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftwise.llm.packing import Example, Piece, examples_of
from liftwise.llm.tokens import default_path

POOL_TOKENS = 1 << 19
NEARLY_FULL = 0.995
FLUSH_TOKENS = 1 << 20  # of output rows in a batch


class CapacityTree:
    """Counts of open rows by remaining capacity (0..width), searched for the best fit."""

    def __init__(self, width: int):
        self.size = 1 << width.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: dict[int, list[int]] = {}

    def put(self, room: int, row: int) -> None:
        self.rows.setdefault(room, []).append(row)
        k = self.size + room
        while k:
            self.count[k] += 1
            k >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Removes and returns (room, row) of the smallest room >= need."""
        k, count = self.size + need, self.count
        while not count[k]:
            while k & 1:  # up while k is a right child
                k >>= 1
            if not k:
                return None
            k += 1
        while k < self.size:
            k = 2 * k if count[2 * k] else 2 * k + 1
        room = k - self.size
        while k:
            count[k] -= 1
            k >>= 1
        return room, self.rows[room].pop()


def best_fit_decreasing(pieces: list[Piece], width: int) -> list[list[Piece]]:
    tree, rows = CapacityTree(width), []
    for p in sorted(pieces, key=lambda p: -p.length):
        found = tree.take(p.length)
        if found is None:
            found = width, len(rows)
            rows.append([])
        room, k = found
        rows[k].append(p)
        tree.put(room - p.length, k)
    return rows


def rows_of(examples: Iterable[Example], width: int) -> Iterator[list[Piece]]:
    pool: list[Piece] = []
    held = 0
    for ex in examples:
        for a in range(0, ex.n, width):
            p = Piece(ex, a, min(width, ex.n - a))
            if p.length == width:
                yield [p]
            else:
                pool.append(p)
                held += p.length
        if held >= POOL_TOKENS:
            rows, pool, held = best_fit_decreasing(pool, width), [], 0
            least = NEARLY_FULL * width
            for k, row in enumerate(rows):
                used = sum(p.length for p in row)
                if used >= least or k < len(rows) // 2:  # half at least go, so that pools end
                    yield row
                else:
                    pool += row
                    held += used
    yield from best_fit_decreasing(pool, width)


SCHEMA = "row_id long, ids binary, cu_seqlens array<int>, position_resets array<int>, doc_ids array<long>, starts array<long>"


def pack_matrix(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    row_tokens: int = 2048,
    tokenizer: str | None = None,
    end_id: int = 49407,
    pad_id: int = 0,
) -> DataFrame:
    path = tokenizer or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        i32 = pa.list_(pa.int32())
        types = (pa.int64(), pa.binary(), i32, i32, pa.list_(pa.int64()), pa.list_(pa.int64()))
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        pad = np.uint32(pad_id).tobytes()
        for row in rows_of((e for b in batches for e in examples_of(b, path, end_id)), row_tokens):
            cu = [0]
            for p in row:
                cu.append(cu[-1] + p.length)
            raw = b"".join(p.example.ids[4 * p.start : 4 * (p.start + p.length)] for p in row)
            resets = cu if cu[-1] < row_tokens else cu[:-1]
            rows.append((number, raw + pad * (row_tokens - cu[-1]), cu, resets, [p.example.doc_id for p in row], [p.start for p in row]))
            number += 1
            if len(rows) * row_tokens >= FLUSH_TOKENS:
                yield out()
                rows.clear()
        if rows:
            yield out()

    cols = [F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")]
    return df.select(*cols).mapInArrow(run, SCHEMA)


def position_ids(cu_seqlens: list[int], row_tokens: int) -> np.ndarray:
    """Position ids of one matrix row: from 0 in each segment and in the padding."""
    cu = np.append(np.asarray(cu_seqlens, np.int64), row_tokens)
    return np.arange(row_tokens) - np.repeat(cu[:-1], np.diff(cu))


def write_matrix(df: DataFrame, path: str, **options) -> None:
    """Pack `df` and write the matrix rows as Parquet."""
    pack_matrix(df, **options).write.mode("overwrite").parquet(path)


def unpack(packed: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of every segment, for an exact round trip."""
    seg = packed.select("ids", "cu_seqlens", F.posexplode(F.arrays_zip("doc_ids", "starts")).alias("k", "s"))
    a, b = F.col("cu_seqlens")[F.col("k")], F.col("cu_seqlens")[F.col("k") + 1]
    return seg.select(F.col("s.doc_ids").alias("doc_id"), F.col("s.starts").alias("start"), F.expr("substring(ids, 4 * cu_seqlens[k] + 1, 4 * (cu_seqlens[k + 1] - cu_seqlens[k]))").alias("ids"), (b - a).alias("length"))
