"""URL filter lists as of the fetch time (DataFrame functions only).

List entries are dated events: a domain is added to or removed from a list. Per (list,
domain) the events become validity intervals (from an event's date to the next one's), and
every capture is evaluated against the entries active on its fetch date: an as-of join on
the domain, where a capture's domains are its host and the host's parents of two labels or
more.

Plan: events are first reduced to one per (list, domain, date), so the interval window sees
at most one row per date, however many raw rows a domain has. Captures are reduced to their
distinct (host, date) before the join, which runs on (domain, year) with the exact dates as
residual condition. The verdicts are written, then joined to the captures on (host, date);
both sides are plain exchanges, so a host with a third of all captures is split by adaptive
skew handling.

Defined results: on one date a removal beats an addition; entries with a null list, domain,
date or action have no effect, other actions than add and remove neither; a null or hostless
URL, or a null date, matches nothing and is not blocked; repeated captures are all returned;
empty lists block nothing; further capture columns are passed through (those named as the
results are replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from liftwise.llm.common import hold

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#@]+)"
RESULTS = ("host", "blocked", "n_entries", "lists", "domains")


def host_of(url: Column) -> Column:
    h = F.rtrim(F.lower(F.regexp_extract(url, HOST, 1)), F.lit("."))
    return F.when(h != "", h)


def domains_of(host: Column) -> Column:
    """The host and its parents of at least two labels."""
    labels = F.split(host, r"\.")
    starts = F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1)))
    return F.transform(starts, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, domain, valid_from, valid_to): the dates [from, to) on which an entry is active."""
    daily = (
        entries.select("list", F.rtrim(F.lower("domain"), F.lit(".")).alias("domain"), F.col("at").cast("date").alias("at"), F.lower("action").alias("action"))
        .where("list IS NOT NULL AND domain IS NOT NULL AND at IS NOT NULL AND action IN ('add', 'remove')")
        .groupBy("list", "domain", "at")
        .agg(F.max(F.col("action") == "remove").alias("removed"))
    )
    w = Window.partitionBy("list", "domain").orderBy("at")
    spans = daily.withColumn("valid_to", F.lead("at").over(w)).where("NOT removed")
    return spans.select("list", "domain", F.col("at").alias("valid_from"), "valid_to")


def filter_urls(captures: DataFrame, entries: DataFrame, url_col: str = "url", date_col: str = "fetch_date") -> DataFrame:
    """`captures` with host, blocked, n_entries, lists and domains (sorted, comma separated)."""
    rest = [c for c in captures.columns if c not in RESULTS]
    rows = captures.select(
        host_of(F.col(url_col)).alias("_host"), F.col(date_col).cast("date").alias("_date"), F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_row")
    )
    seen = rows.where("_host IS NOT NULL AND _date IS NOT NULL").groupBy("_host", "_date").agg(F.lit(1).alias("_one"))
    asked = seen.select("_host", "_date", F.explode(domains_of(F.col("_host"))).alias("domain"), F.year("_date").alias("year"))
    last_year = captures.agg(F.max(F.year(F.col(date_col).cast("date")))).first()[0] or 0
    end = F.least(F.coalesce(F.year("valid_to"), F.lit(last_year)), F.lit(last_year))
    by_year = intervals(entries).withColumn("end_year", end).where("year(valid_from) <= end_year").withColumn("year", F.explode(F.expr("sequence(year(valid_from), end_year)")))
    hits = asked.join(by_year, ["domain", "year"]).where("_date >= valid_from AND (valid_to IS NULL OR _date < valid_to)")
    verdict = hits.groupBy("_host", "_date").agg(
        F.count(F.lit(1)).alias("n_entries"),
        F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"),
        F.array_join(F.array_sort(F.collect_set("domain")), ",").alias("domains"),
    )
    out = rows.join(hold(verdict, "url-verdicts"), ["_host", "_date"], "left")
    return out.select(
        *[F.col(f"_row.`{c}`").alias(c) for c in rest],
        F.col("_host").alias("host"),
        F.col("n_entries").isNotNull().alias("blocked"),
        F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"),
        F.coalesce("lists", F.lit("")).alias("lists"),
        F.coalesce("domains", F.lit("")).alias("domains"),
    )


def derived_captures(pages: DataFrame) -> DataFrame:
    """The pages, with a fetch date from the page id (the table has none)."""
    return pages.select("page_id", "url", F.expr("date_add(DATE'2021-01-01', CAST(pmod(page_id, 1096) AS INT))").alias("fetch_date"))


def derived_entries(pages: DataFrame) -> DataFrame:
    """Dated entries for half of the domains seen in the pages: added, removed, added again
    on days taken from the domain's MD5."""
    domain = pages.select(F.explode(domains_of(host_of(F.col("url")))).alias("domain")).distinct()
    part = lambda a: F.conv(F.substring("h", a, 3), 16, 10).cast("int")
    d = domain.withColumn("h", F.md5("domain")).where("substring(h, 1, 1) < '8'")
    first = part(2) % 1096
    second = first + 1 + part(5) % 400
    events = F.array(
        F.struct(F.lit("add").alias("action"), first.alias("day")),
        F.struct(F.lit("remove").alias("action"), second.alias("day")),
        F.struct(F.lit("add").alias("action"), (second + part(8) % 400).alias("day")),
    )
    name = F.when(F.substring("h", 11, 1) < "8", "abuse").otherwise("adult")
    return d.select(name.alias("list"), "domain", F.explode(events).alias("e")).select(
        "list", "domain", "e.action", F.expr("date_add(DATE'2021-01-01', e.day)").alias("at")
    )


ORACLE = """
WITH p AS (
  SELECT page_id, nullif(rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#@]+)', 1)), '.'), '') AS host,
         DATE '2021-01-01' + CAST(page_id % 1096 AS INTEGER) AS fetch_date
  FROM pages
), s AS (
  SELECT *, string_split(host, '.') AS lab FROM p
), asked AS (
  SELECT page_id, fetch_date, array_to_string(lab[i:], '.') AS domain
  FROM (SELECT *, unnest(range(1, greatest(len(lab) - 1, 1) + 1)) AS i FROM s WHERE host IS NOT NULL)
), h AS (
  SELECT domain, md5(domain) AS h FROM (SELECT DISTINCT domain FROM asked)
), n AS (
  SELECT domain, CASE WHEN h[11] < '8' THEN 'abuse' ELSE 'adult' END AS list,
         CAST('0x' || h[2:4] AS INTEGER) % 1096 AS a, CAST('0x' || h[5:7] AS INTEGER) % 400 AS b, CAST('0x' || h[8:10] AS INTEGER) % 400 AS c
  FROM h WHERE h[1] < '8'
), entry AS (
  SELECT domain, list, DATE '2021-01-01' + a AS lo, DATE '2021-01-01' + (a + 1 + b) AS hi FROM n
  UNION ALL
  SELECT domain, list, DATE '2021-01-01' + (a + 1 + b + c), DATE '9999-12-31' FROM n WHERE c > 0
), hit AS (
  SELECT page_id, count(*) AS n, string_agg(DISTINCT list, ',' ORDER BY list) AS lists, string_agg(DISTINCT asked.domain, ',' ORDER BY asked.domain) AS domains
  FROM asked JOIN entry ON asked.domain = entry.domain AND fetch_date >= lo AND fetch_date < hi GROUP BY page_id
)
SELECT p.page_id, p.host, p.fetch_date, hit.n IS NOT NULL AS blocked, coalesce(n, 0) AS n_entries,
       coalesce(lists, '') AS lists, coalesce(domains, '') AS domains
FROM p LEFT JOIN hit ON p.page_id = hit.page_id
"""
