"""Spelling variants: near words found by reduced-alphabet neighbourhoods, and their forms.

Two words are near if they differ by exactly one inserted, deleted or replaced code point. A
word's form is its near word of the largest count (ties: the smallest in code-point order) if
that count is at least `ratio` times its own; its root is the end of the chain of forms.

Method. A hash maps every letter to one of a few symbols, so near words have reduced words
within one edit of each other. Of each reduced word the full neighbourhood is generated: the
word itself, all deletions, replacements and insertions over the few symbols, each once. They
are 64-bit hashes, computed for all words of a length together from prefix sums. Joined to
the vocabulary's own reduced words they give every near pair exactly once per direction; the
join's condition verifies the original strings, so nothing else leaves it.

Plan: words are counted with map-side aggregation (a hot word is one row per task); the
vocabulary is written once; a bitmap of its reduced words (`FILTER_BITS`, a fixed size) goes to
the tasks and drops neighbours that no word has before they are shuffled; the join on the
64-bit key is a plain equi-join, in which adaptive skew handling splits a hot reduced word on
either side; forms are an aggregation per word; roots by pointer doubling (a form has `ratio`
times the count, so chains are short: 5 rounds reach the end of any chain of longs).

Defined results: null and empty texts have no words; a null id alters nothing of its text;
repeated rows count as often as they occur; a word without near words has n_near 0 and itself
as root; an empty table gives no rows. Only the named columns are read, so others cannot
clash. Words of any length are taken whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftwise.llm.common import hold, id_text
from liftwise.llm.words import codes, mix

LETTERS = r"[A-Za-zÀ-ÿ]"
SYMBOLS = 8
FILTER_BITS = 1 << 25  # 4 MB
BLOCK = 1 << 20  # generated neighbours at a time
U = np.uint64
_BASE, _BASE_INV = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


def counted_words(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 7,
    min_count: int = 2,
    alter: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """(word, n): runs of letters of at least `min_chars` code points with A-Z lower-cased, in
    at least `min_count` places. `alter` (of id and word) may shorten a word before counting."""
    runs = F.expr(f"regexp_extract_all(text, r'{LETTERS}{{{int(min_chars)},}}', 0)")
    words = id_text(df, id_col, text_col).select("doc_id", F.explode(runs).alias("run"))
    low = F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = words.select("doc_id", low.alias("word"))
    if alter is not None:
        words = words.select(alter(F.col("doc_id"), F.col("word")).alias("word")).where(F.length("word") >= min_chars)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def dropped_letters(doc_id: Column, word: Column) -> Column:
    """The words that op11 is defined on: with h = crc32 of `<doc_id>:<word>`, a word whose h is
    divisible by 31 loses the code point number h % length."""
    h = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), word).cast("binary"))
    k = (h % F.length(word)).cast("int")
    cut = F.concat(F.substring(word, F.lit(1), k), F.substring(word, k + 2, F.length(word)))
    return F.when(h % 31 == 0, cut).otherwise(word)


def _symbol_values(c: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Each code point's symbol, and the symbols' random 64-bit values."""
    of_symbol = mix(np.arange(1, symbols + 1, dtype=U) * U(0xD6E8FEB86659FD93))
    return (mix(c.astype(U) + U(1)) % U(symbols)).astype(np.int64), of_symbol


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions in `words`, code points of them as a matrix) for each length."""
    n = np.array([len(w) for w in words])
    for length in np.unique(n):
        at = np.flatnonzero(n == length)
        for a in range(0, len(at), max(1, BLOCK // int(length))):
            some = at[a : a + max(1, BLOCK // int(length))]
            yield some, codes("".join([words[i] for i in some])).reshape(len(some), length)


def _key(polynomial: np.ndarray, length: int) -> np.ndarray:
    return mix(polynomial + U(length))


def _powers(n: int) -> np.ndarray:
    up = np.full(n, _BASE, U)
    up[0] = 1
    return np.cumprod(up, dtype=U)


def reduced_keys(words: list[str], symbols: int = SYMBOLS) -> np.ndarray:
    """64-bit hash of each word's reduced word."""
    out = np.zeros(len(words), U)
    for at, c in _by_length(words):
        s, of = _symbol_values(c, symbols)
        out[at] = _key((of[s] * _powers(c.shape[1])).sum(axis=1, dtype=U), c.shape[1])
    return out


def neighbourhood(words: list[str], symbols: int = SYMBOLS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (position in `words`, hash): each reduced word and all reduced words one edit
    away, each once. Of equal results one edit is made: a deletion from the end of a stretch of
    one symbol, an insertion of a symbol behind a stretch of it."""
    for at, c in _by_length(words):
        m, length = c.shape
        up, inverse = _powers(length + 2), U(_BASE_INV)
        step = max(1, BLOCK // (symbols * 2 + 2))  # positions at a time, of one word or more
        for r in range(0, m, max(1, step // length)):
            rows = slice(r, r + max(1, step // length))
            s, of = _symbol_values(c[rows], symbols)
            v = of[s] * up[:length]
            pre = np.concatenate((np.zeros((len(s), 1), U), np.cumsum(v, axis=1, dtype=U)), axis=1)
            total = pre[:, -1:]
            own = at[rows]
            yield own, _key(total[:, 0], length)
            for a in range(0, length + 1, step):
                b = min(a + step, length)
                here = s[:, a:b]
                after = np.concatenate((s, np.full((len(s), 1), -1)), axis=1)
                last = here != after[:, a + 1 : b + 1]  # the last of its stretch
                gone = pre[:, a:b] + (total - pre[:, a + 1 : b + 1]) * inverse
                i, j = np.nonzero(last)
                yield own[i], _key(gone[i, j], length - 1)
                for x in range(symbols):
                    i, j = np.nonzero(here != x)
                    yield own[i], _key(total[i, 0] + (of[x] - of[here[i, j]]) * up[a + j], length)
                    ends = after[:, a : min(a + step, length + 1)] != x  # not before the same symbol
                    i, j = np.nonzero(ends)
                    p = pre[i, a + j]
                    yield own[i], _key(p + of[x] * up[a + j] + (total[i, 0] - p) * U(_BASE), length + 1)


def _with_keys(words: DataFrame, symbols: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = reduced_keys(batch.column(0).to_pylist(), symbols).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(key)], names=["word", "n", "key"])

    return words.select("word", F.col("n").cast("long").alias("n")).mapInArrow(run, "word string, n long, key long")


def _bitmap(vocabulary: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of the keys: `bits` / 8 bytes whatever the size of the vocabulary."""
    slot = F.col("key").bitwiseAND(F.lit(bits - 1))
    pages = vocabulary.select(F.shiftright(slot, 15).alias("page"), slot.bitwiseAND(F.lit(32767)).alias("bit"))
    out = np.zeros((bits >> 15, 4096), np.uint8)
    for r in pages.groupBy("page").agg(F.bitmap_construct_agg("bit").alias("b")).collect():
        out[r.page] = np.frombuffer(r.b, np.uint8)
    return out.reshape(-1)


def _neighbours(vocabulary: DataFrame, symbols: int, bitmap: np.ndarray) -> DataFrame:
    """(key, word): the keys of each word's neighbourhood that the bitmap has."""
    mask = U(len(bitmap) * 8 - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0)
            for at, key in neighbourhood(words.to_pylist(), symbols):
                slot = key & mask
                there = (bitmap[slot >> U(3)] >> (slot & U(7)).astype(np.uint8)) & 1 > 0
                if there.any():
                    yield pa.RecordBatch.from_arrays([pa.array(key[there].view(np.int64)), words.take(pa.array(at[there]))], names=["key", "word"])

    return vocabulary.select("word").mapInArrow(run, "key long, word string")


def near_words(vocabulary: DataFrame, symbols: int = SYMBOLS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(word, near, near_n): all ordered pairs of near words of `vocabulary` (word, n, key)."""
    bitmap = _bitmap(vocabulary, filter_bits)
    near = vocabulary.select("key", F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = _neighbours(vocabulary, symbols, bitmap).join(near, "key")
    return pairs.where(F.levenshtein("word", "near", 1) == 1).select("word", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the rows of (word, form): forms followed to the last, by doubling."""
    top = forms.select("word", F.col("form").alias("root"))
    while True:
        on = top.select(F.col("word").alias("mid"), F.col("root").alias("up"))
        step = top.join(on, top.root == on.mid, "left")
        top = hold(step.select("word", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")), "roots")
        if top.where("moved").isEmpty():
            return top.select("word", "root")


def variants(words: DataFrame, ratio: int = 10, symbols: int = SYMBOLS) -> DataFrame:
    """Per row of `words` (word, n), which are distinct: word, form, root, n, n_near, form_n."""
    vocabulary = hold(_with_keys(words, symbols), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near"))
    per_word = near_words(vocabulary, symbols).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    found = vocabulary.drop("key").join(per_word, "word", "left")
    is_form = -F.col("best.minus_n") >= ratio * F.col("n")
    found = hold(
        found.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, F.col("best.near")).alias("form"),
            F.when(is_form, -F.col("best.minus_n")).alias("form_n"),
        ),
        "forms",
    )
    top = roots(found.where("form IS NOT NULL").select("word", "form"))
    out = found.join(top, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE = """
WITH tab AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, z : CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS c
    FROM range(256) r(i))
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents WHERE text IS NOT NULL
), low AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS k
  FROM runs WHERE length(run) >= 7 GROUP BY ALL
), hashed AS (
  SELECT w, k, xor(4294967295::UBIGINT, list_reduce(
    list_prepend(4294967295::UBIGINT, flatten(list_transform(string_split(doc_id || ':' || w, ''), lambda ch :
      CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::UBIGINT]
           ELSE [192 + (unicode(ch) >> 6), 128 + (unicode(ch) & 63)]::UBIGINT[] END))),
    lambda c, b : xor(c >> 8, tab.t[1 + (xor(c, b) & 255)::BIGINT]))) AS h
  FROM low, tab
), altered AS (
  SELECT CASE WHEN h % 31 = 0 THEN w[:(h % length(w))::INT] || w[(h % length(w))::INT + 2:] ELSE w END AS word, k FROM hashed
), v AS (
  SELECT word, sum(k)::BIGINT AS n FROM altered WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2
), d AS (
  SELECT word, n, i, word[:i] || word[i + 2:] AS gone
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)
), pairs AS (
  SELECT DISTINCT x.word, y.word AS near, y.n AS near_n FROM d x JOIN d y
    ON x.gone = y.gone AND x.i = y.i AND length(x.word) = length(y.word) AND x.word <> y.word
  UNION SELECT DISTINCT x.word, y.word, y.n FROM d x JOIN v y ON x.gone = y.word
  UNION SELECT DISTINCT y.word, x.word, x.n FROM d x JOIN v y ON x.gone = y.word
), best AS (
  SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS r FROM pairs
), f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * v.n THEN near END AS form,
         CASE WHEN near_n >= 10 * v.n THEN near_n END AS form_n
  FROM v LEFT JOIN best ON v.word = best.word AND r = 1
), f1 AS (SELECT f.word, coalesce(g.form, f.form, f.word) AS top FROM f LEFT JOIN f g ON f.form = g.word
), f2 AS (SELECT a.word, b.top FROM f1 a JOIN f1 b ON a.top = b.word
), f3 AS (SELECT a.word, b.top FROM f2 a JOIN f2 b ON a.top = b.word
), f4 AS (SELECT a.word, b.top FROM f3 a JOIN f3 b ON a.top = b.word
), f5 AS (SELECT a.word, b.top FROM f4 a JOIN f4 b ON a.top = b.word
)
SELECT f.word, f.form, f5.top AS root, f.n, f.n_near, f.form_n FROM f JOIN f5 ON f.word = f5.word
"""
