"""Intervention lookup by free-text name, many lookups in one job.

A name matches a text if it contains the text's tokens in order, anywhere, ignoring case. Equal
names are compared once, and so are texts of equal tokens.

Of each token of a text the run of up to three characters that fewest names have stands for it.
A text's key is its rarest such runs, of up to `DEPTH` different tokens, rarest first. Names are
brought to the keys a run at a time: a name that has a key's first run goes on to the keys that
begin with it, if it has their next run too. So a name meets the texts whose rarest runs it
has, not all that share one frequent run with it, and is checked against their whole patterns.
A text with a run that no name has matches nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftwise.session import cut_lineage

GRAM = 3
DEPTH = 4  # runs in a key, each of another token; the pattern decides beyond them


def tokens_of(text: Column) -> Column:
    """Tokens of a text: quotes and percent signs dropped, split on white space, lower case."""
    cleaned = F.lower(F.trim(F.regexp_replace(text, "['%]", "")))
    return F.filter(F.split(cleaned, r"\s+"), lambda t: t != "")


def name_pattern(text: Column) -> Column:
    """LIKE pattern of a text: 'Mobile order' -> '%mobile%order%'. Backslash and underscore are
    ordinary characters of a name."""
    escaped = F.transform(tokens_of(text), lambda t: F.regexp_replace(t, r"([\\_])", r"\\$1"))
    return F.concat(F.lit("%"), F.array_join(escaped, "%"), F.lit("%"))


def _runs(text: Column, size: Column) -> Column:
    """All runs of `size` characters (an array; empty if the text is shorter)."""
    n = F.length(text) - size + 1
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(text, i, size))).otherwise(
        F.array().cast("array<string>")
    )


def _grams(name: Column) -> Column:
    """The distinct runs of 1 to 3 characters of a name."""
    return F.array_distinct(F.concat(*[_runs(name, F.lit(n)) for n in range(1, GRAM + 1)]))


def distinct_names(view: DataFrame) -> DataFrame:
    """(lname, intervention_id): the first id (by id order) of each name; null names are none."""
    return view.groupBy(F.lower("name").alias("lname")).agg(F.min("intervention_id").alias("intervention_id")).where("lname IS NOT NULL")


def text_keys(patterns: DataFrame, frequency: DataFrame) -> DataFrame:
    """(pattern, keys): the rarest run of each token, (n_names, gram), rarest first and at most
    `DEPTH`; texts with a run that no name has are left out."""
    grams = patterns.select("pattern", F.posexplode("tokens").alias("nth", "token"))
    own = F.array_distinct(_runs(F.col("token"), F.least(F.length("token"), F.lit(GRAM))))
    counted = grams.select("pattern", "nth", F.explode(own).alias("gram")).join(frequency, "gram", "left")
    least = F.min(F.struct(F.coalesce("n_names", F.lit(0)).alias("n_names"), "gram"))
    of_token = counted.groupBy("pattern", "nth").agg(least.alias("rare"))
    keys = of_token.groupBy("pattern").agg(F.array_sort(F.collect_set("rare")).alias("keys")).where("keys[0].n_names > 0")
    return keys.select("pattern", F.slice("keys", 1, DEPTH).alias("keys"))


def _key(keys: Column, depth: int) -> Column:
    """The first runs of a text's key as one string (runs have no blanks)."""
    return F.array_join(F.slice(keys["gram"], 1, depth), " ")


def names_of_keys(names: DataFrame, texts: DataFrame, frequency: DataFrame) -> DataFrame:
    """(key, lname, intervention_id): the names that have all runs of a text's key."""
    used = texts.select(F.explode("keys.gram").alias("gram")).distinct()
    have = names.select("lname", "intervention_id", F.explode(_grams(F.col("lname"))).alias("gram")).join(used, "gram", "left_semi").join(frequency, "gram")
    have = cut_lineage(have.groupBy("lname", "intervention_id").agg(F.array_sort(F.collect_set(F.struct("n_names", "gram"))).alias("have")))
    at = have.select("lname", "intervention_id", "have", F.posexplode("have").alias("nth", "g")).withColumn("key", F.col("g.gram"))
    found = None
    for depth in range(1, DEPTH + 1):
        here = texts.where(F.size("keys") >= depth)
        level = here.groupBy(_key(F.col("keys"), depth).alias("key")).agg(F.min(F.size("keys")).alias("least"), F.max(F.size("keys")).alias("most"))
        at = at.drop("g").join(level, "key")
        ended = at.where(F.col("least") == depth).select("key", "lname", "intervention_id")
        found = ended if found is None else found.unionAll(ended)
        if depth < DEPTH:
            at = cut_lineage(at.where(F.col("most") > depth).drop("least", "most"))
            rest = F.transform(F.slice("have", F.col("nth") + 2, F.size("have")), lambda g, i: F.struct((i + F.col("nth") + 1).alias("nth"), g["gram"].alias("gram")))
            at = at.withColumn("g", F.explode(rest)).withColumn("nth", F.col("g.nth")).withColumn("key", F.concat_ws(" ", "key", "g.gram"))
    return found


def lookup_intervention(view: DataFrame, lookups: DataFrame) -> DataFrame:
    """(query_id, query_text, intervention_id): the first id (by id order) whose name matches
    the text; a text without tokens matches every name; NULL when nothing matches."""
    names = cut_lineage(distinct_names(view))
    asked = lookups.select("query_id", F.lower(name_pattern(F.col("query_text"))).alias("pattern"), tokens_of(F.col("query_text")).alias("tokens"))
    frequency = cut_lineage(names.select(F.explode(_grams(F.col("lname"))).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n_names")))
    texts = cut_lineage(text_keys(asked.where(F.size("tokens") > 0).select("pattern", "tokens").distinct(), frequency))
    of_key = texts.select("pattern", _key(F.col("keys"), DEPTH).alias("key"))
    hits = of_key.join(names_of_keys(names, texts, frequency), "key").where("lname LIKE pattern")
    of_pattern = hits.groupBy("pattern").agg(F.min("intervention_id").alias("intervention_id"))
    best = asked.select("query_id", "pattern").join(of_pattern, "pattern").groupBy("query_id").agg(F.min("intervention_id").alias("intervention_id"))
    # texts without tokens: the first of all named interventions, joined on a key they share
    first = view.where("name IS NOT NULL").agg(F.min("intervention_id").alias("intervention_id"))
    first = first.withColumn("n_tokens", F.pmod(F.xxhash64("intervention_id"), F.lit(1)))  # 0
    empty = asked.select("query_id", F.size("tokens").cast("long").alias("n_tokens")).join(F.broadcast(first), "n_tokens").drop("n_tokens")  # one row
    return lookups.select("query_id", "query_text").join(best.unionByName(empty), "query_id", "left")
