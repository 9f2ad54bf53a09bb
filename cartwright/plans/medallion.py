"""Bronze, silver and gold tables of one source, each written once and read by everything above it."""

from __future__ import annotations

from collections.abc import Callable
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.operators.sinks import write_clustered, write_partitioned, write_small_partitions
from cartwright.plans import gold, silver
from cartwright.session import run_together, scratch_scope

# Table: builder, partition columns, audit column.
_TABLES: dict[str, tuple[Callable[["Medallion"], DataFrame], list[str], str | None]] = {
    "bronze.events_raw": (lambda m: m.source(), ["event_date"], None),
    "silver.events_deduplicated": (lambda m: silver.deduplicated(m["bronze.events_raw"]), [], None),
    "silver.events_cleaned": (
        lambda m: silver.events_cleaned(m["silver.events_deduplicated"]),
        ["event_year", "event_month"],
        "_transform_time",
    ),
    "silver.stg_events": (lambda m: silver.stg_events(m["silver.events_deduplicated"]), ["event_date"], "_transform_time"),
    "silver.dim_products": (lambda m: silver.dim_products(m["silver.events_cleaned"]), [], "_created_at"),
    "silver.dim_users": (lambda m: silver.dim_users(m["silver.events_cleaned"]), [], "_created_at"),
    "silver.stg_products": (lambda m: silver.stg_products(m["silver.stg_events"]), [], "_created_at"),
    "silver.stg_users": (lambda m: silver.stg_users(m["silver.stg_events"]), [], "_created_at"),
    "gold.daily_sales": (
        lambda m: gold.daily_sales(m["silver.events_cleaned"]),
        ["sale_year", "sale_month"],
        "_aggregated_at",
    ),
    "gold.funnel_analysis": (
        lambda m: gold.funnel_daily(m["silver.events_cleaned"]),
        ["analysis_year", "analysis_month"],
        "_aggregated_at",
    ),
    "gold.customer_rfm": (lambda m: gold.customer_rfm(m["silver.events_cleaned"]), [], "_aggregated_at"),
    "gold.hourly_traffic": (
        lambda m: gold.hourly_traffic(m["silver.events_cleaned"]),
        ["event_date"],
        "_aggregated_at",
    ),
    "gold.product_performance": (
        lambda m: gold.product_ranks(gold.product_performance(m["silver.events_cleaned"])),
        [],
        "_aggregated_at",
    ),
    "gold.fct_daily_sales": (
        lambda m: gold.fct_daily_sales(m["silver.stg_events"]),
        ["sale_year", "sale_month"],
        "_aggregated_at",
    ),
    "gold.fct_funnel": (
        lambda m: gold.fct_funnel(m["silver.stg_events"]),
        ["analysis_year", "analysis_month"],
        "_aggregated_at",
    ),
    "gold.dim_customer_rfm": (
        lambda m: gold.dim_customer_rfm(m["silver.stg_events"], m.as_of),
        [],
        "_created_at",
    ),
}

# Sorted by type, a reader of purchases skips the row groups of all other events.
CLUSTERED = {"silver.events_cleaned": ["event_type", "event_date"]}
# At most one row per hour and event type in each day.
SMALL_PARTITIONS = {"gold.hourly_traffic"}

JOB_TABLES = [
    "silver.dim_products",
    "silver.dim_users",
    "gold.daily_sales",
    "gold.funnel_analysis",
    "gold.customer_rfm",
    "gold.hourly_traffic",
    "gold.product_performance",
]
MODEL_TABLES = [
    "silver.stg_products",
    "silver.stg_users",
    "gold.fct_daily_sales",
    "gold.fct_funnel",
    "gold.dim_customer_rfm",
]


class Medallion:
    """Tables below `root`, built from `source` on first use. `as_of` dates the SQL-model segments."""

    def __init__(self, spark: SparkSession, root: str, source: Callable[[], DataFrame], as_of: Column):
        self.spark = spark
        self.root = root
        self.source = source
        self.as_of = as_of
        self._tables: dict[str, DataFrame] = {}
        self._locks = {name: Lock() for name in _TABLES}

    def path(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def __getitem__(self, name: str) -> DataFrame:
        """The named table; written first if this object has not written it yet."""
        with self._locks[name]:
            if name not in self._tables:
                self._tables[name] = self._build(name)
        return self._tables[name]

    def _build(self, name: str) -> DataFrame:
        build, partition_by, audit = _TABLES[name]
        with scratch_scope(self.spark):
            df = build(self)
            stamped = df.withColumn(audit, F.current_timestamp()) if audit else df
            if name in CLUSTERED:
                write_clustered(stamped, self.path(name), partition_by, CLUSTERED[name])
            elif name in SMALL_PARTITIONS:
                write_small_partitions(stamped, self.path(name), *partition_by)
            else:
                write_partitioned(stamped, self.path(name), *partition_by)
        return self.spark.read.schema(stamped.schema).parquet(self.path(name)).select(*stamped.columns)

    def build(self, names: list[str]) -> None:
        """Builds tables at the same time, so that short stages of one fill the gaps of another.

        What several of them read is written first, in order.
        """
        shared = "silver.stg_events" if set(names) <= set(MODEL_TABLES) else "silver.events_cleaned"
        self[shared]
        run_together(*[lambda n=name: self[n] for name in names])
