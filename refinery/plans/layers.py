"""Layer order: landing files -> bronze -> silver -> gold -> quality report.

Each step reads the previous layer's tables and fully refreshes its own, so any
step can be re-run alone and gives the same tables.  A whole run stages the
tables of all layers and publishes them together when the last one is written
(or when the report over them has no error): a run that fails in any layer leaves
every table as it was.  Tables that do not depend on each other are written side
by side.  Tables are Parquet in three schemas (one per layer) whose folders sit
under a shared root.

The counts that the report needs of a whole table are taken while it is written.
"""

from __future__ import annotations

import contextlib
import datetime as _dt
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.operators.keys import dense_key, kept_key
from refinery.plans import gold, quality, silver
from refinery.plans.checks import Check, Metric, Sum, sums_of
from refinery.session import concurrently, materialize, release_shuffles, remove_folder
from refinery.sources import files
from refinery.sources.files import Staging
from refinery.sources.schemas import LAYERS, SOURCE_BY_TABLE, SOURCES


@dataclass(frozen=True)
class Layers:
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    # When set, silver sales and the customer dimension are bucketed on
    # customer_id into this many buckets, so the fact's customer lookup is a
    # sort-merge join without a shuffle on either side (for a customer
    # dimension too large to broadcast).  The layout is written as asked: AQE
    # cannot split a bucket, so do not ask for it when one customer holds far
    # more than a bucket's share of the sales (``top_key_share`` tells).
    customer_buckets: int | None = None
    # When set, the fact table carries ``order_month`` (first day of the order
    # month) and is written partitioned by it, so date filters prune folders.
    fact_by_month: bool = False
    # When set, the fact's customer join is salted over this many sub-keys
    # for customers holding a large share of the sales.
    salt_customers: int | None = None
    # When set, a refresh keeps the surrogate keys of known dimension rows and
    # numbers new ones after them.  The maps are the gold tables
    # ``customer_keys`` and ``product_keys``, published with the dimensions.
    keep_keys: bool = False

    @classmethod
    def with_prefix(cls, prefix: str, customer_buckets: int | None = None, fact_by_month: bool = False,
                    salt_customers: int | None = None, keep_keys: bool = False) -> Layers:
        return cls(prefix + "bronze", prefix + "silver", prefix + "gold", customer_buckets, fact_by_month,
                   salt_customers, keep_keys)

    def bucketing(self, table: str) -> dict:
        if self.customer_buckets and table in ("crm_sales", "dim_customers"):
            return {"bucket_by": "customer_id", "buckets": self.customer_buckets}
        return {}

    def table(self, layer: str, name: str) -> str:
        return f"`{getattr(self, layer)}`.`{name}`"


# The gold tables and the silver tables each is made of.
CUSTOMER_PARTS = ("crm_customers", "erp_customers", "erp_customer_location")
PRODUCT_PARTS = ("crm_products", "erp_product_category")
GOLD_TABLES = ("dim_customers", "dim_products", "fact_sales")

# The codec of the tables that hold sales lines, a quarter to a third
# smaller with it.  The others keep the session's codec: they are looked up, and
# the planner sizes lookups by the bytes of the files.
CODECS = {"crm_sales_details": "zstd", "crm_sales": "zstd", "fact_sales": "zstd"}


class ChecksFailed(RuntimeError):
    """A run whose report has errors, and which therefore published nothing."""

    def __init__(self, report: DataFrame, failed: Sequence[str]):
        super().__init__(f"not published, failed checks: {', '.join(failed)}")
        self.report = report


class Run:
    """One run of layer steps: staged tables and what was measured on the way."""

    def __init__(self, spark: SparkSession, layers: Layers, stage: Staging, checks: Sequence[Check] = (),
                 as_of: _dt.date | str | None = None, keep_landing: bool = True):
        self.spark, self.layers, self.stage, self.checks, self.as_of = spark, layers, stage, checks, as_of
        self.keep_landing = keep_landing

    def read(self, layer: str, name: str) -> DataFrame:
        return self.stage.read(self.layers.table(layer, name))

    def _measures(self, layer: str, name: str) -> dict[str, Column]:
        return {s.expr: s.column() for s in sums_of(self.checks, f"{layer}.{name}")}

    def write(self, df: DataFrame, layer: str, name: str, **layout) -> None:
        self.stage.write(df, self.layers.table(layer, name), measures=self._measures(layer, name), compression=CODECS.get(name), **layout)

    def known(self) -> dict[Metric, int]:
        """The sums that were taken while the tables were written."""
        logical = {self.layers.table(*t.split(".")): t for t in table_names()}
        return {Sum(logical[table], expr): value for (table, expr), value in self.stage.measured.items()}

    def bronze(self, landing_root: str, source: str) -> None:
        """A raw extract becomes a typed bronze table; what does not fit its type
        is kept in the column ``_rejected``."""
        spec = SOURCE_BY_TABLE[source]
        files.ingest_source(self.spark, landing_root, self.layers.table("bronze", source), spec, self.stage,
                            measures=self._measures("bronze", source), compression=CODECS.get(source))
        if not self.keep_landing:
            remove_folder(self.spark, files.extract_folder(landing_root, spec))

    def silver(self, target: str) -> None:
        source, job = silver.SILVER_JOBS[target]
        raw = self.read("bronze", source).drop(files.REJECTED)
        cleaned = job(raw, self.as_of) if job is silver.silver_erp_customers else job(raw)
        self.write(cleaned, "silver", target, **self.layers.bucketing(target))

    def _keyed(self, build: Callable[..., DataFrame], parts: Sequence[str], keys_table: str, layout: dict) -> None:
        numbering = dense_key
        if self.layers.keep_keys:
            map_name = self.layers.table("gold", keys_table)
            known = self.spark.table(map_name) if self.spark.catalog.tableExists(map_name) else None

            def numbering(rows: DataFrame, order: Sequence[str], key: str) -> DataFrame:
                keyed, now_known = kept_key(rows, order, key, known)
                self.stage.write(now_known, map_name)
                return keyed

        dim = build(*[self.read("silver", t) for t in parts], numbering=numbering)
        self.write(dim, "gold", build.__name__, **layout)

    def dim_customers(self) -> None:
        self._keyed(gold.dim_customers, CUSTOMER_PARTS, "customer_keys", self.layers.bucketing("dim_customers"))

    def dim_products(self) -> None:
        self._keyed(gold.dim_products, PRODUCT_PARTS, "product_keys", {})

    def fact_sales(self) -> None:
        fact = gold.fact_sales(self.read("silver", "crm_sales"), self.read("gold", "dim_products"),
                               self.read("gold", "dim_customers"), salt_customers=self.layers.salt_customers)
        if self.layers.fact_by_month:
            fact = fact.withColumn("order_month", F.trunc("order_date", "month"))
            self.write(fact, "gold", "fact_sales", partition_by="order_month", spread_by=("order_number",))
        else:
            self.write(fact, "gold", "fact_sales")

    def all_layers(self, landing_root: str) -> None:
        """Every table as soon as what it is made of is there."""
        def cleaned(target: str) -> Callable[[], None]:
            def load() -> None:
                self.bronze(landing_root, silver.SILVER_JOBS[target][0])
                self.silver(target)
            return load

        def dimension(parts: Sequence[str], build: Callable[[], None]) -> Callable[[], None]:
            def load() -> None:
                concurrently(*[cleaned(t) for t in parts])
                build()
            return load

        concurrently(dimension(CUSTOMER_PARTS, self.dim_customers), dimension(PRODUCT_PARTS, self.dim_products),
                     cleaned("crm_sales"))
        release_shuffles(self.spark)         # the fact shuffles the most: nothing that is over lies beside it
        self.fact_sales()
        release_shuffles(self.spark)


def table_names() -> list[str]:
    """The logical names (``layer.table``) that checks use."""
    return ([f"bronze.{s.table}" for s in SOURCES] + [f"silver.{t}" for t in silver.SILVER_JOBS] + [f"gold.{t}" for t in GOLD_TABLES])


@contextlib.contextmanager
def _run(spark: SparkSession, layers: Layers, **more) -> Iterator[Run]:
    """A run of its own that is published at the end."""
    with Staging(spark) as stage:
        yield Run(spark, layers, stage, **more)
        stage.publish()


def create_layers(spark: SparkSession, layers: Layers, root: str | None = None) -> None:
    files.create_layer_schemas(spark, root, {layer: getattr(layers, layer) for layer in LAYERS})


def run_bronze(spark: SparkSession, landing_root: str, layers: Layers) -> dict[str, str]:
    """The bronze layer alone: every raw extract under the landing root."""
    with _run(spark, layers) as run:
        concurrently(*[lambda s=s: run.bronze(landing_root, s.table) for s in SOURCES])
    return {s.table: layers.table("bronze", s.table) for s in SOURCES}


def run_silver(spark: SparkSession, layers: Layers, as_of: _dt.date | str | None = None) -> dict[str, str]:
    """The silver layer alone, from the bronze tables: six independent cleaning jobs."""
    with _run(spark, layers, as_of=as_of) as run:
        concurrently(*[lambda t=t: run.silver(t) for t in silver.SILVER_JOBS])
    return {t: layers.table("silver", t) for t in silver.SILVER_JOBS}


def run_gold(spark: SparkSession, layers: Layers) -> dict[str, str]:
    """The gold layer alone, from the silver tables; the fact needs both dimensions."""
    with _run(spark, layers) as run:
        concurrently(run.dim_customers, run.dim_products)
        run.fact_sales()
    return {n: layers.table("gold", n) for n in GOLD_TABLES}


def report(spark: SparkSession, layers: Layers, checks: Sequence[Check] = quality.CHECKS,
           known: Mapping[Metric, int] | None = None) -> DataFrame:
    """The quality report over the tables in use; ``known`` are metrics of
    them that are already measured (see ``build``)."""
    return quality.dq_report({t: spark.table(layers.table(*t.split("."))) for t in table_names()}, known, checks)


def build(spark: SparkSession, landing_root: str, layers: Layers, root: str | None = None, as_of: _dt.date | str | None = None,
          checks: Sequence[Check] = quality.CHECKS, only_if_passed: bool = False, keep_landing: bool = True) -> dict[Metric, int]:
    """Write the tables of all layers and publish them together.  Returns the
    counts for ``checks`` that were taken on the way.  With ``only_if_passed`` the
    report over the staged tables comes first, and ``ChecksFailed`` is raised, with
    nothing published, when a check fails (warnings do not).  Without
    ``keep_landing`` an extract's landing files are deleted once its bronze table
    is written, also if the run fails later: for landing folders made for one run."""
    create_layers(spark, layers, root)
    with Staging(spark) as stage:
        run = Run(spark, layers, stage, checks, as_of, keep_landing)
        run.all_layers(landing_root)
        known = run.known()
        if only_if_passed:
            told = materialize(quality.dq_report({t: run.read(*t.split(".")) for t in table_names()}, known, checks), "report")
            failed = [r.check_name for r in told.filter("status = 'fail'").orderBy("check_id").collect()]   # at most one row a check
            if failed:
                raise ChecksFailed(told, failed)
        stage.publish()
    return known


def run_all(spark: SparkSession, landing_root: str, layers: Layers = Layers(), root: str | None = None,
            as_of: _dt.date | str | None = None, checks: Sequence[Check] = quality.CHECKS, only_if_passed: bool = False) -> DataFrame:
    """Run the layers and return the quality report over the written tables."""
    known = build(spark, landing_root, layers, root, as_of, checks, only_if_passed)
    return report(spark, layers, checks, known)
