"""Declared data tests: unique, not null and accepted values."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.functions.events import EVENT_TYPES
from cartwright.functions.segments import SEGMENTS_12, SEGMENTS_12_DEFAULT


@dataclass(frozen=True)
class TableTests:
    unique: list[str] = field(default_factory=list)
    not_null: list[str] = field(default_factory=list)
    accepted: dict[str, list[str]] = field(default_factory=dict)


# The tests of each table.
SUITE = {
    "stg_events": TableTests(
        unique=["event_id"],
        not_null=["event_id", "event_time", "event_type", "user_id", "product_id", "price"],
        accepted={"event_type": EVENT_TYPES},
    ),
    "stg_products": TableTests(unique=["product_id"], not_null=["product_id"]),
    "stg_users": TableTests(unique=["user_id"], not_null=["user_id", "first_seen", "last_seen", "total_events"]),
    "fct_daily_sales": TableTests(
        unique=["sale_id"], not_null=["sale_id", "sale_date", "total_revenue", "order_count"]
    ),
    "fct_funnel": TableTests(unique=["analysis_date"], not_null=["analysis_date"]),
    "dim_customer_rfm": TableTests(
        unique=["user_id"],
        not_null=["user_id", "recency", "frequency", "monetary", "customer_segment", "rfm_score"],
        accepted={"customer_segment": [label for label, *_ in SEGMENTS_12] + [SEGMENTS_12_DEFAULT]},
    ),
}


def unique_failures(df: DataFrame, table: str, column: str) -> DataFrame:
    """Number of values that occur more than once."""
    repeated = df.where(F.col(column).isNotNull()).groupBy(column).count().where(F.col("count") > 1)
    return repeated.agg(F.count("*").alias("failures")).select(
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), F.lit("unique").alias("test"), "failures"
    )


def row_failures(df: DataFrame, table: str, tests: TableTests) -> DataFrame:
    """Null and unaccepted cells of all columns, counted in one pass over the table."""
    checks = [(c, "not_null", F.col(c).isNull()) for c in tests.not_null]
    checks += [(c, "accepted_values", ~F.col(c).isin(values)) for c, values in tests.accepted.items()]
    results = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(test).alias("test"),
            F.count_if(failed).alias("failures"),
        )
        for column, test, failed in checks
    ]
    return df.agg(F.array(*results).alias("results")).select(F.inline("results"))


def _with_status(failures: DataFrame) -> DataFrame:
    return failures.withColumn("passed", F.col("failures") == 0)


def check_unique(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [unique_failures(tables[t], t, c) for t, tests in SUITE.items() for c in tests.unique]
    return _with_status(reduce(DataFrame.unionByName, parts))


def check_rows(tables: dict[str, DataFrame], *kinds: str) -> DataFrame:
    parts = [row_failures(tables[t], t, tests) for t, tests in SUITE.items()]
    return _with_status(reduce(DataFrame.unionByName, parts).where(F.col("test").isin(*kinds)))


def report(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table, column and test."""
    return check_unique(tables).unionByName(check_rows(tables, "not_null", "accepted_values"))
