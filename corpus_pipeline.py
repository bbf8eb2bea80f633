"""The corpus pipeline: from raw documents to packed training sequences.

Stages, each over all rows its predecessor kept: quality classifier (rejected documents go),
line dedup (repeated lines go), n-gram Jaccard join (one document of each class stays),
benchmark decontamination (documents that contain a test item go), packing. All but the last
return the columns of `documents`; the last returns one row per packed piece.

Defined results of every stage: an empty table gives no rows; columns beyond doc_id and text
are carried along whatever their names; a null text is handled as the empty text and stays
null where the row is kept; rows are judged one by one, repeated rows too, unless a stage says
otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftwise.llm import decontaminate, line_dedup, near_dup, packing, quality
from liftwise.llm.common import hold, id_text, keep_rows, table
from liftwise.llm.sample import fold

QUALITY_THRESHOLD = 0.7


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a quality score of at least 0.7; labels of one fold are never learned. A
    null or empty text has the score of a text without words; a null id cannot be labelled;
    equal texts have equal scores, so repeated rows stay or go together."""
    model = quality.fit(id_text(docs), table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 4) != 2)
    score = model.scorer()
    return keep_rows(docs, "text", lambda texts: [s >= QUALITY_THRESHOLD for s in score(texts)["score"]])


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document has; n_chars follows the text. A
    null text becomes the empty text (one empty line); a row without an id keeps its lines
    and takes no other's; rows of one id are one document, so they keep each other's lines."""
    out = line_dedup.dedup_lines(docs).select(*[f"`{c}`" for c in docs.columns])
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each class of near duplicates. Rows of
    one id stay or go together; texts without words, null ones too, are one class; rows
    without an id are in none and stay."""
    return near_dup.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark, each row judged by itself; null and
    empty texts contain none. Null and empty items are skipped."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a packed sequence, with its token ids. A null or empty text is one
    piece, the closing id; null ids stay null; repeated rows are packed as often as they
    occur."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", near_dup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: SQL cannot train the classifier or run the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = hold(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
