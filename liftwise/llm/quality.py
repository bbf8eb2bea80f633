"""Quality classifier: supervised subword embeddings.

Features of a text are its words and its character n-grams (case and signs kept), each hashed
into one of `buckets` rows of an embedding table. A document is the mean of its feature
vectors; a linear layer and softmax give the class probabilities. Table and layer are learned
together by numpy stochastic gradient descent on a bounded labelled sample; the whole corpus
is scored in Spark tasks. For scoring, table and layer are multiplied once, so that a
feature costs one gather, and all features of a batch of texts are hashed by array passes.

Defined results: null and empty texts get the model's bias (the training prior); null ids
stay; repeated rows are scored each; an empty table gives no rows; with no labelled rows of
one class the score is 0.5 throughout; labels, lang, source and doc_id are never features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftwise.llm.common import id_text
from liftwise.llm.sample import labelled_sample, score_texts
from liftwise.llm.words import codes, mix

U = np.uint64


@dataclass(frozen=True)
class Params:
    buckets: int = 1 << 16  # a power of two
    dim: int = 8
    grams: tuple[int, ...] = (3, 4)
    rows: tuple[int, int] = (1500, 1500)  # bound of the sample: rows of label 0 and of label 1
    max_chars: int = 20_000  # and characters of a row
    epochs: int = 5
    rate: float = 4.0
    seed: int = 7


def features(texts: list[str], p: Params) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per kind of feature: (buckets, text by text; number of features of each text).

    Kinds: character n-grams, words, and pairs of adjacent words. A pair of equal words is one
    feature, whatever the word, so that repetition is learned as such.
    """
    c = codes("\n".join(texts) + "\n")
    n, mask = len(c), U(p.buckets - 1)
    lens = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    ends = np.cumsum(lens)
    base = mix(c.astype(U) + U(1))
    rolled = base
    for size in range(2, max(p.grams) + 1):
        if n < size:
            break
        rolled = rolled[:-1] * U(0x9E3779B97F4A7C15) + base[size - 1 :]
        if size in p.grams:
            inside = np.ones(n, bool)  # by the n-gram's first character
            for k in range(1, size):
                inside[np.maximum(ends - k, 0)] = False
            keep = inside[: n - size + 1]
            first = np.concatenate(([0], np.cumsum(keep)))
            upto = first[np.minimum(ends, n - size + 1)]
            yield (mix(rolled) & mask).astype(np.int32)[keep], np.diff(upto, prepend=0)
    blank = (c == 32) | ((c >= 9) & (c <= 13))
    edge = np.flatnonzero(np.diff(~blank, prepend=False, append=False))
    s = edge[0::2]
    if not len(s):
        return
    # a word's hash: its mixed code points with their places in the word
    begin = np.zeros(n, np.int64)
    begin[s] = s
    np.maximum.accumulate(begin, out=begin)
    v = mix(base + (np.arange(n) - begin).astype(U) * U(0xD6E8FEB86659FD93))
    v[blank] = 0
    h = mix(np.add.reduceat(v, s) + U(1))
    first = np.searchsorted(s, np.concatenate(([0], ends)))
    count = np.diff(first)
    yield (h & mask).astype(np.int32), count
    follows = np.ones(len(h), bool)
    follows[first[:-1][count > 0]] = False  # a text's first word follows none
    pair = mix(h[:-1] * U(0xD6E8FEB86659FD93) + h[1:] + U(2))
    pair[h[1:] == h[:-1]] = U(0x5851F42D4C957F2D)
    yield (pair & mask).astype(np.int32)[follows[1:]], np.maximum(count - 1, 0)


def _sums(values: np.ndarray, count: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    upto = np.cumsum(count)
    return total[upto] - total[upto - count]


@dataclass
class Model:
    params: Params
    table: np.ndarray  # buckets x dim
    layer: np.ndarray  # dim x 2
    bias: np.ndarray  # 2

    def scorer(self):
        """texts -> probability of label 1; ships one number per bucket."""
        logit = (self.table @ (self.layer[:, 1] - self.layer[:, 0])).astype(np.float32)
        offset, p = float(self.bias[1] - self.bias[0]), self.params

        def score(texts: list[str]) -> dict[str, list]:
            x, n = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
            for f, count in features(texts, p):
                x += _sums(logit[f], count)
                n += count
            x = x / np.maximum(n, 1) + offset
            return {"score": (1 / (1 + np.exp(-np.clip(x, -40, 40)))).tolist()}

        return score


def train(texts: list[str], y: np.ndarray, p: Params = Params()) -> Model:
    """Stochastic gradient descent, a document a step, with a linearly falling rate; both
    classes weigh the same."""
    rng = np.random.default_rng(p.seed)
    table = rng.uniform(-1 / p.dim, 1 / p.dim, (p.buckets, p.dim))
    layer, bias = rng.normal(0, 1, (p.dim, 2)), np.zeros(2)
    count = np.bincount(y, minlength=2)
    if not count.all():
        return Model(p, table * 0, layer, bias)
    bags = []
    for t in texts:  # distinct features and their shares
        f, n = np.unique(np.concatenate([f for f, _ in features([t], p)] or [np.zeros(0, np.int32)]), return_counts=True)
        bags.append((f, n / max(1, n.sum())))
    weight = len(y) / (2 * count)
    target = np.eye(2)
    steps, done = p.epochs * len(y), 0
    for _ in range(p.epochs):
        for i in rng.permutation(len(y)):
            rate = p.rate * (1 - done / steps)
            done += 1
            f, share = bags[i]
            rows = table[f]
            x = share @ rows
            z = x @ layer + bias
            z = np.exp(z - z.max())
            err = rate * weight[y[i]] * (z / z.sum() - target[y[i]])
            back = layer @ err
            layer -= np.outer(x, err)
            bias -= err
            rows -= np.outer(share, back)
            table[f] = rows
    return Model(p, table, layer, bias)


def fit(docs: DataFrame, labels: DataFrame, keep: Column, p: Params = Params()) -> Model:
    """Fitted on labelled rows of `docs` (doc_id, text) that satisfy `keep`."""
    texts, y = labelled_sample(docs, labels, "quality", keep, p.rows, p.max_chars)
    return train(texts, y, p)


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    return score_texts(id_text(df, id_col, text_col), model.scorer(), "doc_id long, score double", [pa.float64()])


def classify(df: DataFrame, labels: DataFrame, keep: Column, threshold: float = 0.7, p: Params = Params()) -> DataFrame:
    """(doc_id, score, predicted) of every row of df, learned from its labelled rows in `keep`."""
    docs = id_text(df)
    return score(docs, fit(docs, labels, keep, p)).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
