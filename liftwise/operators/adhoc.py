"""Free-form SELECT over an allow-list of views.

The statement is checked three times, by what may be there and not by what may not. Parsed: one
query of plain relational nodes, over allowed names, calling allowed functions by plain names.
Analysed, in a session of its own that holds the allowed views and nothing else: every leaf of
the plan is one of those views or holds no data. And the session is not the caller's, so the
caller's views and temporary functions can neither be read nor replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession


class AdhocRejected(ValueError):
    pass


#: Functions of values only (no session, file, class or catalog behind them).
FUNCTIONS = frozenset(
    """
    any_value approx_count_distinct avg bool_and bool_or corr count count_if covar_pop covar_samp every first
    first_value kurtosis last last_value max max_by mean median min min_by mode percentile percentile_approx
    skewness some std stddev stddev_pop stddev_samp sum try_avg try_sum var_pop var_samp variance
    cume_dist dense_rank lag lead nth_value ntile percent_rank rank row_number
    abs bround ceil ceiling exp floor greatest least ln log log10 log2 mod negative pmod positive pow power
    round sign sqrt try_divide width_bucket
    coalesce if ifnull isnan isnotnull isnull nanvl nullif nvl nvl2
    bigint boolean date decimal double float int smallint string timestamp tinyint
    add_months current_date date_add date_diff date_format date_part date_sub date_trunc datediff day dayname
    dayofmonth dayofweek dayofyear extract last_day make_date month monthname months_between next_day quarter
    to_date trunc weekday weekofyear year
    btrim char_length concat concat_ws contains endswith initcap instr left length like lower lpad ltrim
    regexp_extract regexp_like regexp_replace replace right rlike rpad rtrim split startswith substr substring
    trim upper
    array array_contains array_distinct array_join array_max array_min array_size cardinality element_at explode
    named_struct posexplode sequence size slice sort_array struct
    + - * / % = == <=> < <= > >= != <> ! and between div in not or when
    """.split()
)

#: Parsed nodes that only relate, filter, group, order or limit rows.
PARSED_NODES = frozenset(
    """
    Aggregate CTERelationDef CTERelationRef CacheTable Deduplicate Distinct Except Filter Generate GlobalLimit
    Intersect Join LateralJoin LocalLimit LocalRelation Offset OneRowRelation Pivot Project Sort SubqueryAlias
    Tail Union UnresolvedHaving UnresolvedInlineTable UnresolvedRelation UnresolvedSubqueryColumnAliases
    UnresolvedWith Unpivot Window WithCTE WithWindowDefinition
    """.split()
) - {"CacheTable"}

NAMED_CALLS = ("UnresolvedFunction", "UnresolvedGenerator")
REFUSED_EXPRESSIONS = ("UnresolvedIdentifier", "NamedParameter", "PosParameter", "VariableReference", "ScalaUDF", "PythonUDF", "Invoke")
EMPTY_LEAVES = ("OneRowRelation", "LocalRelation", "CTERelationRef")
SESSION_SETTINGS = ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions", "spark.sql.ansi.enabled", "spark.sql.adaptive.enabled", "spark.sql.caseSensitive")


def _each(seq) -> Iterator:
    return (seq.apply(i) for i in range(seq.size()))


def _kind(node) -> str:
    return node.getClass().getSimpleName().rstrip("$")


def _name(parts) -> str:
    return parts.mkString(".").lower()


def _check_expression(e) -> None:
    kind = _kind(e)
    if any(x in kind for x in REFUSED_EXPRESSIONS):
        raise AdhocRejected(f"not allowed in a query: {kind}")
    if kind in NAMED_CALLS:
        name = _name(e.nameParts() if kind == "UnresolvedFunction" else e.name().nameParts())
        if name not in FUNCTIONS:
            raise AdhocRejected(f"function outside the allow-list: {name}")
    for child in _each(e.children()):
        _check_expression(child)


def _check_parsed(plan, allowed: frozenset[str]) -> None:
    kind = _kind(plan)
    if kind not in PARSED_NODES:
        raise AdhocRejected(f"not allowed in a query: {kind}")
    if kind == "UnresolvedRelation" and _name(plan.multipartIdentifier()) not in allowed:
        raise AdhocRejected(f"relation outside the allow-list: {_name(plan.multipartIdentifier())}")
    if kind == "UnresolvedWith":
        for cte in _each(plan.cteRelations()):  # a CTE may read those before it
            _check_parsed(cte._2(), allowed)
            allowed = allowed | {cte._1().lower()}
    for e in _each(plan.expressions()):
        _check_expression(e)
    for below in (plan.children(), plan.subqueries()):
        for p in _each(below):
            _check_parsed(p, allowed)


def _check_analysed(plan, allowed: frozenset[str]) -> None:
    kind = _kind(plan)
    if kind == "View":
        if not plan.isTempView() or plan.desc().identifier().table().lower() not in allowed:
            raise AdhocRejected(f"reads {plan.desc().identifier()}, which is outside the allow-list")
        return
    if not plan.children().size() and kind not in EMPTY_LEAVES:
        raise AdhocRejected(f"reads a relation outside the allow-list: {kind}")
    for below in (plan.children(), plan.subqueries(), *([plan.cteDefs()] if kind == "WithCTE" else [])):
        for p in _each(below):
            _check_analysed(p, allowed)


def _session_of(spark: SparkSession, views: Mapping[str, DataFrame]) -> SparkSession:
    """A session with the given views and no others."""
    own = spark.newSession()
    for key in SESSION_SETTINGS:
        own.conf.set(key, spark.conf.get(key))
    for name, df in views.items():
        rows = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(own._jsparkSession, df._jdf.queryExecution().analyzed())
        rows.createOrReplaceTempView(name)
    return own


def adhoc_sql(spark: SparkSession, sql: str, allowed_views: Mapping[str, DataFrame]) -> DataFrame:
    """Run one read-only SELECT over the allowed views; anything else is `AdhocRejected`. The
    result belongs to a session of its own, which needs a classic (not a remote) session."""
    names = frozenset(n.lower() for n in allowed_views)
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except Exception as e:
        raise AdhocRejected(f"not a single SELECT statement: {str(e).splitlines()[0]}") from e
    _check_parsed(plan, names)
    out = _session_of(spark, allowed_views).sql(sql)
    _check_analysed(out._jdf.queryExecution().analyzed(), names)
    return out
