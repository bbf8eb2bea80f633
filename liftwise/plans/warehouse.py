"""The medallion as catalog tables: checked while written, switched when whole.

A refresh writes every table under the name of a new version. The public names are views over
one version; they are replaced after all tables are written and every check has held, so a
refresh that fails leaves the version before it in place and drops its own tables. One that
succeeds drops the version before, so it runs when no query still reads that one. The checks
read counts that were observed by the writing job itself (no second scan): the number of rows
of each table against what is expected, and of gold against its transactions, which a
duplicated merchant would multiply.

Silver takes values that are none of their type as rejects, with the reason and the record as
JSON; they are written in the same pass as the good rows, in a partition of their own.

Gold and its weekly sums are partitioned by year and bucketed by merchant, so that the weekly
aggregation and everything per merchant after it need no exchange of gold. A bucket's file of
gold is in the order of the days, so a range of days skips row groups within a year. Matches are computed
from the version that they are published with.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from liftwise import config
from liftwise.operators import lift, matching
from liftwise.operators.weekly import weekly_panel
from liftwise.operators.windows import intervention_windows
from liftwise.plans.causal import CausalRun
from liftwise.plans.medallion import MERCHANT_SCHEMA, TRANSACTION_SCHEMA, gold_enriched, with_calendar

KEYS = {"merchants": ("merchant_id",), "transactions": ("merchant_id", "txn_date")}


class RefreshFailed(RuntimeError):
    """A check did not hold; the version before is still the public one."""


def _fault(name: str, kind: T.DataType, key: bool) -> Column:
    """What is wrong with a value, or NULL."""
    raw = F.col(name)
    typed = raw.try_cast(kind)
    fault = F.when(raw.isNotNull() & typed.isNull(), F.lit(f"{name}: not a {kind.simpleString()}"))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        fault = fault.when(F.abs(typed) >= F.lit(float("inf")), F.lit(f"{name}: not a number"))
    if key:
        fault = fault.when(raw.isNull(), F.lit(f"{name}: missing"))
    return fault


def typed_or_rejected(bronze: DataFrame, ddl: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """The columns of a schema, and `rejected`, `reason` and `record` (the row as JSON) of rows
    with a value that is none of its type or with a missing key; NaN and infinities are no
    amounts. Rejected rows have NULL in the schema's columns."""
    fields = T.StructType.fromDDL(ddl)
    reason = F.concat_ws("; ", *[_fault(f.name, f.dataType, f.name in keys) for f in fields])
    rows = bronze.select(*[F.col(f.name) for f in fields], F.struct(*[F.col(f"`{c}`") for c in bronze.columns]).alias("row"), reason.alias("why"))
    good = F.col("why") == ""
    return rows.select(
        *[F.when(good, F.col(f.name).try_cast(f.dataType)).alias(f.name) for f in fields],
        (~good).alias("rejected"),
        F.when(~good, F.col("why")).alias("reason"),
        F.when(~good, F.to_json("row")).alias("record"),
    )


@dataclass
class Warehouse:
    spark: SparkSession
    schema: str
    location: str | None = None  # of the schema's tables; the session's warehouse if not given
    buckets: int | None = None  # by merchant; from the number of rows if not given
    _new: list[str] = field(default_factory=list)
    _n_buckets: int = 0

    def __post_init__(self) -> None:
        self._n_buckets = self.buckets or 4

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.schema}.{name}")

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(text.replace("{s}", self.schema))

    @contextlib.contextmanager
    def current(self) -> Iterator[None]:
        """The schema as the session's current one: a table function is named without it."""
        before = self.spark.catalog.currentDatabase()
        self.sql("USE {s}")
        try:
            yield
        finally:
            self.spark.sql(f"USE `{before}`")

    def call(self, function: str, **args) -> DataFrame:
        """`SELECT * FROM` a table function of the schema."""
        with self.current():
            return self.spark.sql(f"SELECT * FROM {function}", args=args)

    def create(self) -> None:
        at = f" LOCATION '{self.location}'" if self.location else ""
        self.sql("CREATE SCHEMA IF NOT EXISTS {s}" + at)

    # ------------------------------------------------------------ refresh

    def refresh(
        self,
        merchants: DataFrame,
        transactions: DataFrame,
        interventions: DataFrame,
        cohorts: DataFrame | None = None,
        expected: Mapping[str, int] | None = None,
        max_rejected: int | None = None,
        n_matches: int | None = None,
    ) -> None:
        """Write a version of every table, check it and make it the public one.

        `cohorts` is (intervention_id, merchant_id), of any size; without it the arrays of the
        interventions are unfolded. `expected` are row counts by table, `max_rejected` the
        rejected rows allowed in all. With `n_matches` the causal functions' tables are
        published in the same switch; without it those of an older version are withdrawn.
        """
        self.create()
        old = self._tables()
        version, self._new = uuid.uuid4().hex[:10], []
        try:
            views = self._write_version(version, merchants, transactions, interventions, cohorts, expected or {}, max_rejected)
            if n_matches is not None:
                views |= self._write_matches(version, n_matches)
        except Exception:
            for t in self._new:
                self.sql(f"DROP TABLE IF EXISTS {{s}}.{t}")
            raise
        for name, body in views.items():
            self.sql(f"CREATE OR REPLACE VIEW {{s}}.{name} AS {body}")
        if n_matches is None:
            for name in ("matches", "match_vectors"):
                self.sql(f"DROP VIEW IF EXISTS {{s}}.{name}")
        for t in old:
            self.sql(f"DROP TABLE IF EXISTS {{s}}.{t}")

    def publish_matches(self, n_matches: int = config.DEFAULT_N_MATCHES) -> None:
        """The causal functions' tables for the public version as it is."""
        version, self._new = uuid.uuid4().hex[:10], []
        old = [t for t in self._tables() if t.startswith(("matches__", "match_vectors__"))]
        for name, body in self._write_matches(version, n_matches, public=True).items():
            self.sql(f"CREATE OR REPLACE VIEW {{s}}.{name} AS {body}")
        for t in old:
            self.sql(f"DROP TABLE IF EXISTS {{s}}.{t}")

    def _tables(self) -> list[str]:
        rows = self.sql("SHOW TABLES IN {s}").collect()
        return [r.tableName for r in rows if "__" in r.tableName and not r.isTemporary]

    def _write(self, name: str, version: str, df: DataFrame, partition: tuple[str, ...] = (), order: tuple[str, ...] = ()) -> tuple[DataFrame, dict]:
        """Write a managed table; the counts are observed in the writing stage, whose tasks
        count once each, however often they are tried."""
        seen = Observation(f"{name}-{version}")
        counted = [F.count(F.lit(1)).alias("n")] + [F.count_if("rejected").alias("n_rejected")] * ("rejected" in df.columns)
        if order:
            df = df.repartition(self._n_buckets, "merchant_id")
        writer = df.observe(seen, *counted).write.format(config.TABLE_FORMAT)
        if partition:
            writer = writer.partitionBy(*partition)
        if order:
            writer = writer.bucketBy(self._n_buckets, "merchant_id").sortBy(*order)
        table = f"{name}__{version}"
        self._new.append(table)
        writer.saveAsTable(f"{self.schema}.{table}")
        counts = seen.get
        n, n_rejected = counts.get("n") or 0, counts.get("n_rejected") or 0
        return self.table(table), {"n_rows": n - n_rejected, "n_rejected": n_rejected}

    def _write_version(self, version, merchants, transactions, interventions, cohorts, expected, max_rejected) -> dict[str, str]:
        counts: dict[str, dict] = {}

        def silver(name: str, df: DataFrame, ddl: str) -> DataFrame:
            typed, counts[name] = self._write(name, version, typed_or_rejected(df, ddl, KEYS[name]), partition=("rejected",))
            return typed.where("NOT rejected").select(*T.StructType.fromDDL(ddl).names)

        def plain(name: str, df: DataFrame) -> DataFrame:
            written, counts[name] = self._write(name, version, df)
            return written

        if cohorts is None:
            cohorts = interventions.select("intervention_id", F.explode("treated_merchant_ids").alias("merchant_id"))
        cohorts = cohorts.select("intervention_id", "merchant_id").where("merchant_id IS NOT NULL").distinct()
        with ThreadPoolExecutor(4) as pool:  # independent of each other
            jobs = [
                pool.submit(silver, "merchants", merchants, MERCHANT_SCHEMA),
                pool.submit(silver, "transactions", transactions, TRANSACTION_SCHEMA),
                pool.submit(plain, "interventions", interventions),
                pool.submit(plain, "cohorts", cohorts),
            ]
            m, t, iv, _ = [j.result() for j in jobs]
        if self.buckets is None:
            self._n_buckets = max(4, -(-counts["transactions"]["n_rows"] // config.BUCKET_ROWS))
        gold_rows = gold_enriched(with_calendar(t), m)
        gold, counts["transactions_enriched"] = self._write("transactions_enriched", version, gold_rows, ("year",), ("txn_date", "merchant_id"))
        gold = gold.select(*config.GOLD_COLUMNS)
        _, counts["transactions_weekly"] = self._write("transactions_weekly", version, weekly_panel(gold), ("year",), ("merchant_id", "week_start"))
        expected = {"transactions_enriched": counts["transactions"]["n_rows"]} | dict(expected)
        rows = [(k, c["n_rows"], c["n_rejected"], expected.get(k), expected.get(k) in (None, c["n_rows"])) for k, c in counts.items()]
        unknown = set(expected) - set(counts)
        failed = [f"{k}: {n} rows, expected {e}" for k, n, _, e, ok in rows if not ok] + [f"{k}: no such table" for k in sorted(unknown)]
        n_rejected = sum(c["n_rejected"] for c in counts.values())
        if max_rejected is not None and n_rejected > max_rejected:
            failed.append(f"{n_rejected} rejected rows, at most {max_rejected} allowed")
        if failed:
            raise RefreshFailed("; ".join(failed))
        values = ", ".join(f"('{k}', {n}L, {r}L, {'NULL' if e is None else f'{e}L'}, true)" for k, n, r, e, _ in rows)

        def of(name: str, columns, where: str = "") -> str:
            return f"SELECT {', '.join(columns)} FROM {{s}}.{name}__{version}{where}"

        rejects = [f"SELECT '{k}' AS table_name, reason, record FROM {{s}}.{k}__{version} WHERE rejected" for k in KEYS]
        return {
            "merchants": of("merchants", T.StructType.fromDDL(MERCHANT_SCHEMA).names, " WHERE NOT rejected"),
            "transactions": of("transactions", T.StructType.fromDDL(TRANSACTION_SCHEMA).names, " WHERE NOT rejected"),
            "rejects": " UNION ALL ".join(rejects),
            "interventions": of("interventions", iv.columns),
            "interventions_agent_view": of("interventions", config.AGENT_VIEW_COLUMNS),
            "cohorts": of("cohorts", ("intervention_id", "merchant_id")),
            "transactions_enriched": of("transactions_enriched", config.GOLD_COLUMNS),
            "transactions_weekly": of("transactions_weekly", ("merchant_id", "week_start", "year", "cents", "rests", "days")),
            "quality": f"SELECT table_name, n_rows, n_rejected, CAST(expected_rows AS BIGINT) AS expected_rows, passed "
            f"FROM VALUES {values} AS v(table_name, n_rows, n_rejected, expected_rows, passed)",
        }

    # ------------------------------------------------------------ causal tables

    def run(self, n_matches: int | None = None) -> CausalRun:
        """A causal run over the public version."""
        return self._run({}, n_matches)

    def _run(self, versions: Mapping[str, str], n_matches: int | None) -> CausalRun:
        def table(name: str) -> DataFrame:
            return self.table(versions.get(name, name))

        windows = intervention_windows(table("interventions").select(*config.AGENT_VIEW_COLUMNS))
        return CausalRun(table("transactions_enriched").select(*config.GOLD_COLUMNS), windows, table("cohorts"), n_matches, weekly_table=table("transactions_weekly"))

    def _write_matches(self, version: str, n_matches: int, public: bool = False) -> dict[str, str]:
        versions = {} if public else {t.split("__")[0]: t for t in self._new}
        run = self._run(versions, n_matches)
        self._write("matches", version, run.matches)
        vectors = matching.normalize_vectors(matching.window_vectors(run.weeks, run.windows, bounds=run.bounds))
        dealt = vectors.select("pre_start", "merchant_id", "vec", F.pmod(F.xxhash64("merchant_id"), F.lit(config.SQL_CHUNKS)).cast("int").alias("chunk"))
        self._write("match_vectors", version, dealt)
        values = ", ".join(f"({df}, {t}D)" for df, t in lift.T_CRITICAL)
        return {
            "matches": f"SELECT intervention_id, treated_merchant_id, control_merchant_id, match_rank, similarity_score, {int(n_matches)} AS n_stored FROM {{s}}.matches__{version}",
            "match_vectors": f"SELECT pre_start, merchant_id, vec, chunk FROM {{s}}.match_vectors__{version}",
            "t_critical": f"SELECT * FROM VALUES {values} AS v(df, t_val)",
            "windows": f"SELECT intervention_id, start_date, date_sub(start_date, {config.MATCH_WINDOW_DAYS}) AS pre_start, "
            "date_sub(start_date, 1) AS pre_end, date_add(start_date, int(post_window_days)) AS post_end FROM {s}.interventions_agent_view",
        }
