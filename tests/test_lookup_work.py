"""Name lookup: how many names a text is compared with."""

from __future__ import annotations

from pyspark.sql import functions as F

from liftwise.plans import lookup

WORDS = ["amber", "birch", "cedar", "delta", "ember", "flint", "grove", "heath", "inlet"]


def test_texts_of_frequent_runs_meet_few_names(spark):
    """Every word is in many names, and every text is a whole name, so each run of a text is
    frequent; joined on one run alone, a text would meet the hundreds of names that have it."""
    names = [(f"I{i:03d}", f"{a}_{b}_{c}_{d}") for i, (a, b, c, d) in enumerate((a, b, c, d) for a in WORDS[:5] for b in WORDS[2:7] for c in WORDS[4:] for d in WORDS[:4])]
    texts = [(k, n.replace("_", " ").upper()) for k, (_, n) in enumerate(names)] + [(1000 + k, "'amber'") for k in range(50)]
    view = spark.createDataFrame(names, "intervention_id string, name string")
    asked = spark.createDataFrame(texts, "query_id int, query_text string")
    got = {r.query_id: r.intervention_id for r in lookup.lookup_intervention(view, asked).collect()}
    first = min(i for i, n in names if "amber" in n)
    assert got == {k: i for k, (i, _) in enumerate(names)} | {1000 + k: first for k in range(50)}
    distinct = lookup.distinct_names(view)
    frequency = distinct.select(F.explode(lookup._grams(F.col("lname"))).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n_names"))
    tokens = lookup.tokens_of(F.col("query_text"))
    patterns = asked.select(F.lower(lookup.name_pattern(F.col("query_text"))).alias("pattern"), tokens.alias("tokens")).distinct()
    keys = lookup.text_keys(patterns, frequency)
    met = lookup.names_of_keys(distinct, keys, frequency).join(keys.select("pattern", lookup._key(F.col("keys"), lookup.DEPTH).alias("key")), "key")
    assert met.count() < 30 * len(names)  # one run alone: over 100 names a text
