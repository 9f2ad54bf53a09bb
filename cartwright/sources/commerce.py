"""Maps the given `events` and `part` tables to raw commerce events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.functions.events import date_parts, session_bucket
from cartwright.operators.joins import dimension_join

# Ingestion time and batch id of the first delivery and of the redelivery.
DELIVERIES = [
    ("2024-04-01 00:00:00", "20240401_000000"),
    ("2024-04-02 00:00:00", "20240402_000000"),
]

RAW_COLUMNS = [
    "event_time",
    "event_type",
    "product_id",
    "category_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "user_session",
]
LINEAGE_COLUMNS = ["_ingestion_time", "_source_file", "_batch_id"]


def _event_type() -> F.Column:
    kind, day = F.col("kind"), F.dayofmonth("ts")
    return (
        F.when((day == 7) & (kind == "click"), "view")
        .when((day == 8) & kind.isin("view", "error"), "cart")
        .when(kind == "click", "cart")
        .when(kind == "purchase", "purchase")
        .when(kind == "signup", "remove_from_cart")
        .otherwise("view")
    )


def _category_code() -> F.Column:
    top = F.lower("p_type")
    second = F.concat(top, F.lit(".size"), (F.col("p_size") % 5).cast("string"))
    third = F.concat(F.lit(" "), second, F.lit("."), F.lower(F.replace("p_brand", F.lit("#"), F.lit(""))))
    k = F.col("k")
    return (
        F.when(k % 10 == 0, F.lit(None))
        .when(k % 10 == 1, F.lit("  "))
        .when(k % 3 == 0, top)
        .when(k % 3 == 1, second)
        .otherwise(third)
    )


def _brand() -> F.Column:
    return (
        F.when(F.col("event_id") % 13 == 0, F.lit(None))
        .when(F.col("k") % 7 == 0, F.lit(""))
        .otherwise(F.concat(F.lit(" "), F.col("p_brand"), F.lit(" ")))
    )


def _price() -> F.Column:
    key, value = F.col("event_id"), F.col("value")
    return (
        F.when(key % 53 == 0, F.lit(None))
        .when(key % 59 == 0, -value)
        .when(key % 61 == 0, F.lit(0.0))
        .otherwise(value)
    )


def raw_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event once, and the redelivered ones a second time, in one scan of `events`.

    Columns: the nine raw ones, `_source_file` and `delivery` (0 or 1).
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").alias("buyer"),
        F.col("event_type").alias("kind"),
        "value",
        F.regexp_extract("props", "([0-9]+)", 1).try_cast("long").alias("k"),
        F.col("_metadata.file_path").alias("_source_file"),
    )
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_brand", "p_type", "p_size")
    key = F.col("event_id")
    shifted = F.timestamp_add("DAY", F.element_at(F.array(F.lit(0), F.lit(30), F.lit(60)), (key % 3 + 1).cast("int")), F.col("ts"))
    mapped = dimension_join(events, part, "k", "p_partkey").select(
        "event_id",
        shifted.alias("event_time"),
        _event_type().alias("event_type"),
        F.when(key % 97 != 0, F.col("k")).alias("product_id"),
        F.col("p_size").cast("long").alias("category_id"),
        _category_code().alias("category_code"),
        _brand().alias("brand"),
        _price().alias("price"),
        F.when(key % 101 != 0, F.col("buyer")).alias("user_id"),
        "buyer",
        "_source_file",
    )
    copies = F.when(key % 11 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return mapped.withColumn("delivery", F.explode(copies)).select(
        "event_time",
        "event_type",
        "product_id",
        "category_id",
        "category_code",
        "brand",
        (F.col("price") + F.col("delivery")).alias("price"),
        "user_id",
        session_bucket(F.col("buyer"), F.col("event_time")).alias("user_session"),
        "_source_file",
        "delivery",
    )


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw events with lineage and partition columns of both deliveries."""
    first, second = DELIVERIES
    is_first = F.col("delivery") == 0
    return with_partition_columns(
        raw_deliveries(spark, sf_dir).select(
            *RAW_COLUMNS,
            F.when(is_first, first[0]).otherwise(second[0]).cast("timestamp").alias("_ingestion_time"),
            "_source_file",
            F.when(is_first, first[1]).otherwise(second[1]).alias("_batch_id"),
        )
    )


def with_partition_columns(df: DataFrame) -> DataFrame:
    """Adds date, year and month of the event where the schema has an event time."""
    if "event_time" not in df.columns:
        return df
    parts = date_parts(F.col("event_time"), "event")
    return df.withColumns(
        {
            "event_date": F.to_date("event_time"),
            "event_year": parts["event_year"],
            "event_month": parts["event_month"],
        }
    )
