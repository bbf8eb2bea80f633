"""The registered query of each operator: production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftwise.llm import (
    bpe,
    decontaminate,
    line_dedup,
    mtree,
    near_dup,
    packing,
    periodic,
    quality,
    spelling,
    substring,
    token_output,
    toxicity,
    url_filter,
)
from liftwise.llm.common import table
from liftwise.llm.sample import fold


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 5) == 0
    out = toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "score", "predicted", "spans")


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    out = url_filter.filter_urls(url_filter.derived_captures(pages), url_filter.derived_entries(pages))
    return out.select("page_id", "host", "fetch_date", "blocked", "n_entries", "lists", "domains")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(table(spark, sf_dir, "documents"))


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.pack_matrix(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(table(spark, sf_dir, "documents"), with_ids=False)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 4) == 2
    out = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.counted_words(table(spark, sf_dir, "documents"), alter=spelling.dropped_letters))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.periodic_runs(periodic.with_periodic_tails(table(spark, sf_dir, "documents"))))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.decode(bpe.encode(table(spark, sf_dir, "documents")))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_jaccard_join,
        op2_toxicity,
        op3_top_k,
        op4_url_filters,
        op5_decontamination,
        op6_line_dedup,
        op7_substring_dedup,
        op8_token_output,
        op9_packing,
        op10_quality,
        op11_spelling_variants,
        op12_periodic_runs,
        op13_bpe,
    )
}

ORACLES: dict[str, str] = {
    "op1_jaccard_join": near_dup.ORACLE,
    "op3_top_k": mtree.ORACLE,
    "op4_url_filters": url_filter.ORACLE,
    "op6_line_dedup": line_dedup.ORACLE,
    "op11_spelling_variants": spelling.ORACLE,
}
