"""Packing under several limits at once (vector bin packing, dot-product heuristic).

Examples become pieces with a demand vector (tokens, segments, loss-bearing tokens). Each
piece goes to the open sequence that can take it and whose remaining capacity has the
largest dot product with the demand, both relative to the limits. Examples may be cut
anywhere, so at the end of a pool the emptiest sequences are taken apart and their pieces
cut to fill the gaps of the others; one open sequence at most is carried on per task.

Every task packs its own rows as they stream by: no shuffle, and memory is bounded by a
pool of tokens (plus one example). A task that runs again gives the same rows.

Defined results: null text is the empty text; an example's ids are its text's ids and the
closing id, so an empty text is one id; null ids stay null; repeated rows are packed as
often as they occur; an empty table gives no rows. Loss-bearing tokens are all ids of a
document, or those after the prompt if `prompt_col` names one (null prompt: empty).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftwise.llm.tokens import default_path, encoder
from liftwise.llm.words import chunks

POOL_TOKENS = 1 << 19
OPEN_SEQUENCES = 64
FLUSH_BYTES = 4 << 20  # of output rows in a batch
ROW_BYTES = 500  # of an output row besides its ids, about
ENCODED_CHARS = 1 << 22  # of texts encoded together: a piece is looked up once in them


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 512
    loss: int = 2048

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.segments, self.loss], np.float64)


@dataclass(slots=True)
class Example:
    doc_id: int | None
    ids: bytes  # little-endian unsigned 32 bit
    loss_from: int  # ids from here on bear loss
    n: int


@dataclass(slots=True)
class Piece:
    example: Example
    start: int
    length: int

    def loss(self) -> int:
        return max(0, self.start + self.length - max(self.start, self.example.loss_from))


@dataclass(slots=True)
class Sequence:
    pieces: list[Piece] = field(default_factory=list)
    tokens: int = 0
    loss: int = 0

    def add(self, p: Piece) -> None:
        self.pieces.append(p)
        self.tokens += p.length
        self.loss += p.loss()


def _fitting(p: Piece, tokens: int, loss: int) -> int:
    """The longest prefix of the piece with at most so many tokens and loss-bearing ones."""
    free = max(0, min(p.example.loss_from - p.start, p.length))  # loss-free ids at its front
    return min(p.length, tokens, free + loss)


def _cut(p: Piece, n: int) -> tuple[Piece, Piece]:
    return Piece(p.example, p.start, n), Piece(p.example, p.start + n, p.length - n)


def place(pieces: list[Piece], limits: Limits) -> list[Sequence]:
    """Largest demand first, each to the open sequence of the largest dot product."""
    cap = limits.vector()
    done: list[Sequence] = []
    seqs: list[Sequence] = []
    room = np.empty((0, 3))
    pieces = sorted(pieces, key=lambda p: (-max(p.length / cap[0], p.loss() / cap[2]), p.start))
    for p in pieces:
        need = np.array([p.length, 1, p.loss()], np.float64)
        ok = (room >= need).all(axis=1)
        if ok.any():
            k = int(np.where(ok, room @ (need / cap**2), -1.0).argmax())
        else:
            if len(seqs) >= OPEN_SEQUENCES:  # the fullest closes
                k = int((room / cap).min(axis=1).argmin())
                done.append(seqs.pop(k))
                room = np.delete(room, k, axis=0)
            seqs.append(Sequence())
            room = np.vstack((room, cap))
            k = len(seqs) - 1
        seqs[k].add(p)
        room[k] -= need
    return done + seqs


def top_up(seqs: list[Sequence], limits: Limits) -> tuple[list[Sequence], list[Piece]]:
    """Take the emptiest sequences apart and cut their pieces into the gaps of the others;
    returns the sequences that are as full as their limits allow, and the pieces left."""
    seqs = sorted(seqs, key=lambda s: -s.tokens)
    full: list[Sequence] = []
    loose: list[Piece] = []
    i, j = 0, len(seqs) - 1
    while i <= j:
        s = seqs[i]
        while s.tokens < limits.tokens and len(s.pieces) < limits.segments:
            if not loose:
                if j <= i:
                    break
                loose = seqs[j].pieces
                j -= 1
            p = loose.pop()
            n = _fitting(p, limits.tokens - s.tokens, limits.loss - s.loss)
            if not n:
                loose.append(p)
                break
            head, rest = _cut(p, n)
            s.add(head)
            if rest.length:
                loose.append(rest)
        i += 1
        if s.tokens == limits.tokens or j >= i or loose:
            full.append(s)
        else:
            loose = s.pieces  # the last, part-filled one
    return full, loose


def pack_stream(examples: Iterable[Example], limits: Limits) -> Iterator[Sequence]:
    pool: list[Piece] = []
    held = 0
    for ex in examples:
        p = Piece(ex, 0, ex.n)
        while p.length:
            n = _fitting(p, limits.tokens, limits.loss)
            head, p = _cut(p, n)
            pool.append(head)
            held += head.length
        if held >= POOL_TOKENS:
            full, pool = top_up(place(pool, limits), limits)
            held = sum(q.length for q in pool)
            yield from full
    while pool:
        full, rest = top_up(place(pool, limits), limits)
        yield from full
        if rest and sum(q.length for q in rest) < limits.tokens or not full:
            yield from _tail(rest, limits)
            break
        pool = rest


def _tail(pieces: list[Piece], limits: Limits) -> Iterator[Sequence]:
    """The last pieces of a task in sequences of powers of two, which need no padding."""
    pieces = pieces[::-1]
    left = sum(p.length for p in pieces)
    while left:
        size = min(1 << (left.bit_length() - 1), limits.tokens)
        s = Sequence()
        while s.tokens < size and len(s.pieces) < limits.segments:
            p = pieces.pop()
            n = _fitting(p, size - s.tokens, limits.loss - s.loss)
            if not n:
                pieces.append(p)
                break
            head, rest = _cut(p, n)
            s.add(head)
            if rest.length:
                pieces.append(rest)
        left -= s.tokens
        yield s


def examples_of(batch: pa.RecordBatch, path: str, end_id: int) -> Iterator[Example]:
    """Batch columns: id, text, and a prompt or nothing."""
    ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    prompts = batch.column(2).to_pylist() if batch.num_columns > 2 else None
    enc, end = encoder(path), np.uint32(end_id).tobytes()
    for a, b in chunks(texts, ENCODED_CHARS):
        heads = enc.encode(prompts[a:b]) if prompts else [b""] * (b - a)
        for d, head, raw in zip(ids[a:b], heads, enc.encode(texts[a:b]), strict=True):
            raw = head + raw + end
            yield Example(d, raw, len(head) // 4, len(raw) // 4)


SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, loss_tokens long, ids binary"
)


def pack(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prompt_col: str | None = None,
    limits: Limits = Limits(),
    tokenizer: str | None = None,
    end_id: int = 1,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: where it is from, where it lies, and its ids (null if not wanted)."""
    path = tokenizer or default_path()
    cols = [F.col(id_col).cast("long").alias("doc_id")]
    cols += [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((text_col, "text"), (prompt_col, "prompt")) if c]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        schema = pa.schema(
            [(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens")]
            + [("ids", pa.binary())]
        )
        rows: list[tuple] = []
        held = 0

        def out() -> pa.RecordBatch:
            cols = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

        for s in pack_stream((e for b in batches for e in examples_of(b, path, end_id)), limits):
            at = 0
            for p in s.pieces:
                raw = p.example.ids[4 * p.start : 4 * (p.start + p.length)]
                rows.append((p.example.doc_id, p.start, p.length, zlib.crc32(raw), p.example.n, number, at, p.loss(), raw if with_ids else None))
                at += p.length
                held += len(raw) + ROW_BYTES
            number += 1
            if held >= FLUSH_BYTES:
                yield out()
                rows.clear()
                held = 0
        if rows:
            yield out()

    return df.select(*cols).mapInArrow(run, SCHEMA)
