"""Per-dataset context: the fixture tables and the layers derived from them.

The medallion refresh runs once per (Spark application, dataset): the catalog tables of a
warehouse, in a schema of its own under the shared checkpoint folder, which every query
reads. The tables and functions of the causal calls are published when first asked for.
"""

from __future__ import annotations

import os
import threading
import uuid
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from liftwise.functions import sql_functions
from liftwise.operators.windows import intervention_windows
from liftwise.plans import medallion
from liftwise.plans.warehouse import Warehouse
from liftwise.session import app_key, scratch_path, ship_package
from liftwise.sources import fixture


@dataclass
class Context:
    spark: SparkSession
    sf_dir: str

    @cached_property
    def sources(self) -> fixture.Sources:
        return fixture.load(self.spark, self.sf_dir)

    @cached_property
    def warehouse(self) -> Warehouse:
        name = f"liftwise_{uuid.uuid4().hex[:8]}"
        out = Warehouse(self.spark, name, scratch_path(self.spark, name))
        src = self.sources
        out.refresh(src.merchants, src.transactions, src.interventions, src.cohorts)
        sql_functions.create_metric_function(out)
        return out

    @cached_property
    def published(self) -> Warehouse:
        """The warehouse with the causal functions' tables."""
        sql_functions.publish(self.warehouse)
        return self.warehouse

    @cached_property
    def layers(self) -> medallion.Layers:
        t = self.warehouse.table
        return medallion.Layers(
            t("merchants"), medallion.with_calendar(t("transactions")), t("transactions_enriched"), t("transactions_weekly")
        )

    @property
    def gold(self) -> DataFrame:
        return self.layers.gold

    @property
    def interventions(self) -> DataFrame:
        """The agent-facing view (no `true_effect`)."""
        return self.warehouse.table("interventions_agent_view")

    @property
    def windows(self) -> DataFrame:
        return intervention_windows(self.interventions)

    @property
    def treated(self) -> DataFrame:
        return self.warehouse.table("cohorts")


_CACHE: dict[tuple[str, str], Context] = {}
_LOCK = threading.Lock()


def context(spark: SparkSession, sf_dir: str) -> Context:
    ship_package(spark)
    key = (app_key(spark), os.path.abspath(sf_dir))
    with _LOCK:
        ctx = _CACHE.get(key)
        if ctx is None or ctx.spark is not spark:
            ctx = _CACHE[key] = Context(spark, sf_dir)
        return ctx
