"""Toxicity: a linear-chain conditional random field over the words of a document.

Tagger. Two tags (other, toxic), start and transition weights, and hashed features of each
word: the word, its prefixes and a suffix, and the words beside it. Forward-backward gives
each word's marginal probability of the toxic tag.

Token labels. The labels are per document, so training words are labelled from them: cues
(words or word prefixes) are chosen greedily, each the one that covers most toxic training
documents while hardly occurring in others; a document counts half as much for each cue that
covers it already, until no cue covers enough. In toxic documents the words with a cue are tagged toxic; all others are not.

Scores. A logistic layer over a document's strongest marginal and its expected number of
toxic words gives the score; words of marginal >= 0.5 give the offending offsets.

Training is numpy on a bounded labelled sample; scoring runs in Spark tasks over whole texts,
with the chains of all texts of a batch advanced together.

Defined results: null and empty texts have no words and get the logistic layer's lowest
input, hence a score near 0; null ids stay; repeated rows are scored each; an empty table
gives no rows; without labelled rows of both classes every score is 0; labels, lang, source
and doc_id are never inputs of a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftwise.llm.common import id_text
from liftwise.llm.sample import labelled_sample, score_texts
from liftwise.llm.words import Words, chunks, mix, words_of

U = np.uint64
TOP = 30.0  # bound of a log-odds


@dataclass(frozen=True)
class Params:
    buckets: int = 1 << 18  # a power of two
    prefixes: tuple[int, ...] = (3, 4, 5, 6)
    rows: tuple[int, int] = (3000, 1500)  # bound of the sample: rows of label 0 and of label 1
    max_chars: int = 20_000  # and characters of a row
    epochs: int = 4
    rate: float = 0.5
    batch_chars: int = 100_000
    cue_ratio: float = 30.0  # a cue is so many times as frequent in toxic documents
    least_cover: float = 0.002  # a cue covers so many more of the toxic documents, and two


# ---------------------------------------------------------------- the chain


def _scan(m: np.ndarray) -> np.ndarray:
    """v[t] = m[t] @ v[t-1] for t = 0.. (from the vector (1, 1)), each scaled to sum 1.

    m is (2, 2, n), non-negative. The steps are laid out as columns: first the product of
    every column (all columns together), then the vectors that enter each column, then the
    vectors within all columns together: about 2 sqrt(n) array operations.
    """
    n = m.shape[2]
    if not n:
        return np.zeros((2, 0))
    length = int(np.sqrt(n)) + 1
    cols = -(-n // length)
    pad = np.zeros((2, 2, cols * length))
    pad[:, :, :n] = m
    pad[0, 0, n:] = pad[1, 1, n:] = 1
    m = np.ascontiguousarray(pad.reshape(2, 2, cols, length).transpose(3, 0, 1, 2))  # step, i, j, column
    prod = np.zeros((2, 2, cols))
    prod[0, 0] = prod[1, 1] = 1
    for t in range(length):
        a = m[t]
        prod = a[:, 0, None] * prod[None, 0] + a[:, 1, None] * prod[None, 1]
        prod /= prod.max(axis=(0, 1))
    enter = np.empty((2, cols))
    v = np.array([0.5, 0.5])
    for k in range(cols):
        enter[:, k] = v
        v = prod[:, :, k] @ v
        v /= v.sum()
    out = np.empty((length, 2, cols))
    v = enter
    for t in range(length):
        a = m[t]
        v = a[:, 0] * v[0] + a[:, 1] * v[1]
        v = v / (v[0] + v[1])
        out[t] = v
    return out.transpose(1, 2, 0).reshape(2, -1)[:, :n]


def forward_backward(x: np.ndarray, starts: np.ndarray, begin: float, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of consecutive chains: x[t] is the log-odds of tag 1 from word t's features,
    starts[t] says that a chain begins there, begin is the log-odds of tag 1 at a start and
    trans[i, j] the weight of j after i. Returns P(tag 1) and P(tag before, tag) as (2, 2, n);
    the latter is 0 at starts."""
    n = len(x)
    e = np.exp(np.clip(x, -TOP, TOP))
    t = np.exp(trans)
    m = np.empty((2, 2, n))  # m[j, i]: to tag j from tag i
    m[0, 0], m[0, 1] = t[0, 0], t[1, 0]
    m[1, 0], m[1, 1] = t[0, 1] * e, t[1, 1] * e
    m[0][:, starts] = 1
    m[1][:, starts] = (np.exp(begin) * e[starts])[None]
    alpha = _scan(m)
    back = np.ascontiguousarray(m.transpose(1, 0, 2)[:, :, ::-1])  # beta[t-1] = m[t].T beta[t]
    beta = np.full((2, n), 0.5)
    if n > 1:
        beta[:, :-1] = _scan(back[:, :, : n - 1])[:, ::-1]
    both = alpha * beta
    p = both[1] / both.sum(axis=0)
    pair = np.zeros((2, 2, n))
    if n > 1:
        pair[:, :, 1:] = alpha[:, None, :-1] * m.transpose(1, 0, 2)[:, :, 1:] * beta[None, :, 1:]
        pair /= np.maximum(pair.sum(axis=(0, 1)), 1e-300)
        pair[:, :, starts] = 0
    return p, pair


# ---------------------------------------------------------------- features


def _parts(w: Words, p: Params) -> list[np.ndarray]:
    """64-bit hashes of each word and of its prefixes (0 where the word is not longer)."""
    n = w.end - w.start
    zero = np.zeros_like(n)
    out = [w.hash]
    for k in p.prefixes:
        out.append(np.where(n > k, w.part(zero, np.minimum(n, k)) ^ U(k), U(0)))
    return out


def _features(w: Words, p: Params) -> np.ndarray:
    """(features, words) buckets of the hashed features."""
    n = w.end - w.start
    before, after = np.zeros_like(w.hash), np.zeros_like(w.hash)
    before[1:], after[:-1] = w.hash[:-1], w.hash[1:]
    ends = np.diff(w.first) > 0
    before[w.first[:-1][ends]] = 0
    after[w.first[1:][ends] - 1] = 0
    kinds = [*_parts(w, p), w.part(np.maximum(n - 3, 0), n), before, after]
    return np.stack([(mix(h + U(k + 1)) & U(p.buckets - 1)).astype(np.int32) for k, h in enumerate(kinds)])


def _starts(w: Words) -> np.ndarray:
    out = np.zeros(len(w.hash), bool)
    out[w.first[:-1][np.diff(w.first) > 0]] = True
    return out


def find_cues(texts: list[str], y: np.ndarray, p: Params) -> np.ndarray:
    """Sorted hashes of the words and prefixes chosen to label training words."""
    docs, keys = [], []
    for a, b in chunks(texts):
        w = words_of(texts[a:b])
        doc = np.repeat(np.arange(a, b, dtype=np.int64), np.diff(w.first))
        for h in _parts(w, p):
            docs.append(doc[h > 0])
            keys.append(h[h > 0])
    key, inv = np.unique(np.concatenate(keys), return_inverse=True)
    seen = np.unique(inv.astype(np.int64) * len(y) + np.concatenate(docs))  # distinct (key, document)
    inv, doc = seen // len(y), seen % len(y)
    n1, n0 = max(1, (y == 1).sum()), max(1, (y == 0).sum())
    toxic = np.bincount(inv, y[doc] == 1, len(key))
    clean = np.bincount(inv, y[doc] == 0, len(key))
    good = (toxic >= 2) & (toxic / n1 >= p.cue_ratio * clean / n0)
    use = good[inv] & (y[doc] == 1)
    inv, doc = inv[use], doc[use]
    chosen, need = [], (y == 1).astype(np.float64)
    while len(inv):
        gain = np.bincount(inv, need[doc], len(key)) - clean * (n1 / n0)
        k = int(gain.argmax())
        if gain[k] < max(1.5, p.least_cover * n1):
            break
        chosen.append(k)
        need[doc[inv == k]] /= 2
        doc, inv = doc[inv != k], inv[inv != k]
    return np.sort(key[chosen])


# ---------------------------------------------------------------- model


@dataclass
class Model:
    params: Params
    weight: np.ndarray  # log-odds of the toxic tag by feature bucket
    begin: float
    trans: np.ndarray
    layer: np.ndarray  # bias, strongest log-odds, log expected number

    def marginals(self, w: Words) -> np.ndarray:
        if not len(w.hash):
            return np.zeros(0)
        x = self.weight[_features(w, self.params)].sum(axis=0)
        return forward_backward(x, _starts(w), self.begin, self.trans)[0]

    def inputs(self, w: Words, p: np.ndarray) -> np.ndarray:
        """Per text: 1, the strongest marginal's log-odds, log(1 + expected toxic words)."""
        n = len(w.first) - 1
        out = np.zeros((n, 3))
        out[:, 0], out[:, 1] = 1, -TOP / 3
        full = np.flatnonzero(np.diff(w.first) > 0)
        if len(full):
            top = np.maximum.reduceat(p, w.first[full])
            out[full, 1] = np.clip(np.log(np.maximum(top, 1e-12) / np.maximum(1 - top, 1e-12)), -TOP / 3, TOP / 3)
            out[full, 2] = np.log1p(np.add.reduceat(np.where(p >= 0.05, p, 0), w.first[full]))
        return out

    def scorer(self):
        def score(texts: list[str]) -> dict[str, list]:
            w = words_of(texts)
            p = self.marginals(w)
            z = np.clip(self.inputs(w, p) @ self.layer, -40, 40)
            hot = np.flatnonzero(p >= 0.5)
            doc = np.searchsorted(w.first, hot, side="right") - 1
            spans: list[list[dict]] = [[] for _ in texts]
            last = -2
            for k, d, s, e in zip(hot.tolist(), doc.tolist(), w.start[hot].tolist(), w.end[hot].tolist(), strict=True):
                if k == last + 1 and spans[d]:  # the word after a toxic one joins its span
                    spans[d][-1]["end"] = e
                else:
                    spans[d].append({"start": s, "end": e})
                last = k
            return {"score": (1 / (1 + np.exp(-z))).tolist(), "spans": spans}

        return score


def train(texts: list[str], y: np.ndarray, p: Params = Params()) -> Model:
    model = Model(p, np.zeros(p.buckets, np.float64), -2.0, np.zeros((2, 2)), np.array([-40.0, 0, 0]))
    if not (y == 1).any() or not (y == 0).any():
        return model
    cues = find_cues(texts, y, p)
    order = np.random.default_rng(5).permutation(len(texts))
    texts, y = [texts[i] for i in order], y[order]
    batches = []
    for a, b in chunks(texts, p.batch_chars):
        w = words_of(texts[a:b])
        if not len(w.hash):
            continue
        tagged = np.isin(np.stack(_parts(w, p)), cues).any(axis=0) & (np.repeat(y[a:b], np.diff(w.first)) == 1)
        batches.append((_features(w, p), _starts(w), tagged.astype(np.float64)))
    past = np.full(p.buckets, 1e-2)
    past_t, past_b = np.full((2, 2), 1.0), 1.0
    for _ in range(p.epochs):
        for f, starts, tag in batches:
            x = model.weight[f].sum(axis=0)
            got, pair = forward_backward(x, starts, model.begin, model.trans)
            diff = tag - got
            grad = np.bincount(f.ravel(), np.broadcast_to(diff, f.shape).ravel(), p.buckets)
            past += grad * grad
            model.weight += p.rate * grad / np.sqrt(past)
            is1 = np.stack((1 - tag, tag))
            seen = is1[:, None, :-1] * is1[None, :, 1:] * ~starts[1:]
            g = seen.sum(axis=2) - pair.sum(axis=2)
            past_t += g * g
            model.trans = model.trans + p.rate * g / np.sqrt(past_t)
            g = diff[starts].sum()
            past_b += g * g
            model.begin += p.rate * g / np.sqrt(past_b)
    model.weight = model.weight.astype(np.float32)
    model.layer = _logistic(np.concatenate([model.inputs(w, model.marginals(w)) for w in (words_of(texts[a:b]) for a, b in chunks(texts))]), y)
    return model


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton steps of a logistic regression with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (q * (1 - q) + 1e-9)[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w = w + np.linalg.solve(h, x.T @ (y - q) - 1e-2 * w)
    return w


def fit(docs: DataFrame, labels: DataFrame, keep: Column, p: Params = Params()) -> Model:
    texts, y = labelled_sample(docs, labels, "toxic", keep, p.rows, p.max_chars)
    return train(texts, y, p)


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, spans) of every row; spans are code-point offsets [start, end)."""
    schema = "doc_id long, score double, spans array<struct<start:int,end:int>>"
    return score_texts(id_text(df, id_col, text_col), model.scorer(), schema, [pa.float64(), SPANS])


def classify(df: DataFrame, labels: DataFrame, keep: Column, p: Params = Params()) -> DataFrame:
    docs = id_text(df)
    out = score(docs, fit(docs, labels, keep, p))
    return out.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")
