"""Bounded labelled samples for the classifiers, and batch-wise scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftwise.llm.words import chunks


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, keep: Column, bound: tuple[int, int], max_chars: int
) -> tuple[list[str], np.ndarray]:
    """Texts and 0/1 labels of at most `bound[y]` rows of label y, taken in the order of a hash
    of the id, among labelled rows that satisfy `keep` (over `doc_id`) and have at most
    `max_chars` characters. Both bounds are parameters of the classifiers; they bound what
    reaches the driver. Rows with a null id or label teach nothing.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & keep)
    short = docs.select("doc_id", "text").where(F.length("text") <= max_chars)
    rows = []
    for y in (0, 1):
        # at most twice the bound of ids: a bounded broadcast; the rest make up for long texts
        some = known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * bound[y])
        got = short.join(F.broadcast(some), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(bound[y])
        rows += [(r.text, y) for r in got.select("text").collect()]
    return [t for t, _ in rows], np.array([y for _, y in rows], np.int64)


def score_texts(docs: DataFrame, score: Callable[[list[str]], dict[str, list]], schema: str, types: list[pa.DataType]) -> DataFrame:
    """doc_id and the columns that `score` gives for a list of whole texts. `score` comes to
    the tasks inside the function, so what it holds must be small (a fitted model)."""
    names = [c.strip().split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in chunks(texts):
                got = score(texts[a:b])
                cols = [ids.slice(a, b - a)] + [pa.array(got[n], t) for n, t in zip(names[1:], types, strict=True)]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
