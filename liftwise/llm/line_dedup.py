"""Line dedup over all documents (DataFrame functions only).

A text is split at newlines. A line's key is the line stripped of ASCII white space at both
ends, A-Z lower-cased. Keys of at least `min_chars` code points that occur in at least
`min_docs` documents keep their lines only in the smallest doc_id holding them; all other
lines stay, in order.

Plan: explode to (doc_id, position, 128-bit key hash), count documents per hash with map-side
aggregation, write the shared keys, join them back (both sides are plain exchanges, so a key
that holds a third of all lines is split by adaptive skew handling), gather the dropped
positions per document, and reassemble each text by position. Texts are shuffled once.

Defined results: a null or empty text is one empty line; a row with a null id keeps its lines
and counts for no key; rows with equal ids are one document when keys are counted, and each
is rewritten by itself; an empty table gives no rows; further columns are passed through
(columns named n_lines or n_dropped are replaced).
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftwise.llm.common import hold

WHITE = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WHITE)), string.ascii_uppercase, string.ascii_lowercase)


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc, text_hash, pos, h1, h2) of every line whose key is long enough."""
    line = docs.where("doc IS NOT NULL").select("doc", "text_hash", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    keyed = line.select("doc", "text_hash", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.length("key") >= min_chars).select(
        "doc", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2")
    )


def shared_keys(lines: DataFrame, min_docs: int) -> DataFrame:
    """(h1, h2, first_doc) of keys in at least `min_docs` documents."""
    if min_docs == 2:  # two documents or more: the smallest id is not the largest
        g = lines.groupBy("h1", "h2").agg(F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"))
        return g.where("first_doc < last_doc").drop("last_doc")
    g = lines.groupBy("h1", "h2", "doc").agg(F.lit(1).alias("one")).groupBy("h1", "h2")
    return g.agg(F.min("doc").alias("first_doc"), F.sum("one").alias("n")).where(F.col("n") >= min_docs).drop("n")


def dedup_lines(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, min_docs: int = 2
) -> DataFrame:
    """`df` with `text_col` rewritten, and n_lines (before) and n_dropped."""
    docs = df.select(
        F.col(id_col).alias("doc"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in df.columns if c != text_col]).alias("row"),
    ).withColumn("text_hash", F.xxhash64("text"))
    lines = _lines(docs, min_chars)
    shared = hold(shared_keys(lines, min_docs), "shared-lines")
    dropped = (
        lines.join(shared, ["h1", "h2"])
        .where("doc <> first_doc")
        .groupBy("doc", "text_hash")
        .agg(F.collect_set("pos").alias("drop"))
    )
    split = docs.join(dropped, ["doc", "text_hash"], "left").withColumn("lines", F.split("text", "\n"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drop"))
    out = split.withColumn(
        "new_text",
        F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")),
    )
    cols = [
        F.col("new_text").alias(text_col) if c == text_col else F.col(f"row.`{c}`").alias(c)
        for c in df.columns
        if c not in ("n_lines", "n_dropped")
    ]
    n_dropped = F.when(F.col("drop").isNull(), 0).otherwise(F.size("drop"))
    return out.select(*cols, F.size("lines").cast("long").alias("n_lines"), n_dropped.cast("long").alias("n_dropped"))


ORACLE = """
WITH l AS (
  SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM l
), shared AS (
  SELECT k, min(doc_id) AS first_doc FROM k WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), m AS (
  SELECT k.*, coalesce(shared.first_doc <> k.doc_id, false) AS gone FROM k LEFT JOIN shared ON k.k = shared.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
