"""Clean events and the product and user dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.functions import events as ev
from cartwright.functions.money import exact_mean, from_cents, mean_cents, percent, ratio, to_cents
from cartwright.operators.dedupe import EVENT_KEY, latest_per_key

CLEAN_COLUMNS = [
    "event_time",
    "event_type",
    "product_id",
    "category_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "user_session",
    "category_level1",
    "category_level2",
    "category_level3",
    "brand_normalized",
    "event_hour",
    "is_weekend",
    "price_tier",
    "event_date",
    "event_year",
    "event_month",
]


def of_type(event_type: str) -> Column:
    return F.col("event_type") == event_type


def count_type(event_type: str) -> Column:
    return F.count_if(of_type(event_type))


def purchase_cents() -> Column:
    return F.coalesce(F.sum(F.when(of_type("purchase"), to_cents(F.col("price")))), F.lit(0))


def valid_events(bronze: DataFrame) -> DataFrame:
    return bronze.where(F.col("user_id").isNotNull() & F.col("product_id").isNotNull())


def deduplicated(bronze: DataFrame) -> DataFrame:
    """Latest delivery of each valid event. The filter only reads key columns, so it runs before the shuffle.

    Both clean event tables are made from this one.
    """
    return latest_per_key(valid_events(bronze), EVENT_KEY, ["_ingestion_time"])


def events_cleaned(kept: DataFrame, compat_weekend: bool = False) -> DataFrame:
    """The clean event table of the job variant, from deduplicated events."""
    weekend = ev.is_weekend_compat if compat_weekend else ev.is_weekend
    repaired = kept.select(*CLEAN_COLUMNS[:9], "event_date", "event_year", "event_month").withColumns(
        {
            "brand": ev.clean_brand(F.col("brand")),
            "category_code": ev.clean_category(F.col("category_code")),
            "price": ev.clean_price(F.col("price")),
        }
    )
    return repaired.withColumns(
        {
            **ev.category_levels(F.col("category_code")),
            "brand_normalized": F.lower("brand"),
            "event_hour": F.hour("event_time"),
            "is_weekend": weekend(F.col("event_date")),
            "price_tier": ev.price_tier(F.col("price")),
        }
    ).select(*CLEAN_COLUMNS)


def stg_events(kept: DataFrame) -> DataFrame:
    """The clean event table of the SQL-model variant, from deduplicated events, with a surrogate key and lineage."""
    if "payment_method" not in kept.columns:
        kept = kept.withColumn("payment_method", F.lit(None).cast("string"))
    category = ev.clean_category(F.col("category_code"))
    day = F.col("event_date")
    parts = ev.date_parts(day, "event")
    return kept.select(
        ev.surrogate_key(*[F.col(c) for c in EVENT_KEY]).alias("event_id"),
        "event_time",
        "event_date",
        "event_year",
        "event_month",
        parts["event_day"].alias("event_day"),
        F.hour("event_time").alias("event_hour"),
        parts["event_day_of_week"].alias("day_of_week"),
        "event_type",
        "product_id",
        "category_id",
        category.alias("category_code"),
        *[level.alias(name) for name, level in ev.category_levels(category).items()],
        ev.clean_brand(F.col("brand")).alias("brand"),
        ev.normalised_brand(F.col("brand")).alias("brand_normalized"),
        ev.clean_price_rounded(F.col("price")).alias("price"),
        ev.price_tier_raw(F.col("price")).alias("price_tier"),
        "user_id",
        "user_session",
        "payment_method",
        ev.is_weekend(day).alias("is_weekend"),
        "_ingestion_time",
        "_source_file",
        "_batch_id",
    )


def dim_products(silver: DataFrame) -> DataFrame:
    """Products by id, category and brand; levels and normalised brand follow from the grouping columns."""
    keys = ["product_id", "category_id", "category_code", "brand"]
    grouped = silver.groupBy(*keys).agg(
        F.sum(to_cents(F.col("price"))).alias("cents"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.count("*").alias("total_events"),
        count_type("view").alias("view_count"),
        count_type("cart").alias("cart_count"),
        count_type("purchase").alias("purchase_count"),
    )
    return grouped.select(
        *keys,
        *[level.alias(name) for name, level in ev.category_levels(F.col("category_code")).items()],
        F.lower("brand").alias("brand_normalized"),
        exact_mean(F.col("cents"), F.col("total_events")).alias("avg_price"),
        "min_price",
        "max_price",
        "total_events",
        "view_count",
        "cart_count",
        "purchase_count",
    )


def stg_products(stg: DataFrame) -> DataFrame:
    """Products by id, described by their latest event.

    The events are hashed down to one row per product and description first. Picking the latest
    description needs a sorted aggregate, which then only sees those few rows.
    """
    described = [
        "category_id",
        "category_code",
        "category_level1",
        "category_level2",
        "category_level3",
        "brand",
        "brand_normalized",
    ]
    variants = stg.groupBy("product_id", *described).agg(
        F.max("event_time").alias("last_seen"),
        F.sum(to_cents(F.col("price"))).alias("cents"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.count("*").alias("total_events"),
        count_type("view").alias("view_count"),
        count_type("cart").alias("cart_count"),
        count_type("purchase").alias("purchase_count"),
    )
    sums = ["cents", "total_events", "view_count", "cart_count", "purchase_count"]
    grouped = variants.groupBy("product_id").agg(
        F.max(F.struct("last_seen", *described)).alias("latest"),
        F.min("min_price").alias("min_price"),
        F.max("max_price").alias("max_price"),
        *[F.sum(c).alias(c) for c in sums],
    )
    return grouped.select(
        "product_id",
        *[f"latest.{c}" for c in described],
        mean_cents(F.col("cents"), F.col("total_events")).alias("avg_price"),
        "min_price",
        "max_price",
        "total_events",
        "view_count",
        "cart_count",
        "purchase_count",
        percent(F.col("cart_count"), F.col("view_count")).alias("view_to_cart_rate"),
        percent(F.col("purchase_count"), F.col("cart_count")).alias("cart_to_purchase_rate"),
    )


def _user_counts() -> list[Column]:
    return [
        F.min("event_time").alias("first_seen"),
        F.max("event_time").alias("last_seen"),
        F.count("*").alias("total_events"),
        count_type("view").alias("total_views"),
        count_type("cart").alias("total_carts"),
        count_type("purchase").alias("total_purchases"),
        purchase_cents().alias("cents"),
    ]


def dim_users(silver: DataFrame) -> DataFrame:
    spent, bought = F.col("cents"), F.col("total_purchases")
    return (
        silver.groupBy("user_id")
        .agg(*_user_counts())
        .select(
            "user_id",
            "first_seen",
            "last_seen",
            "total_events",
            "total_views",
            "total_carts",
            "total_purchases",
            from_cents(spent).alias("total_spent"),
            bought.alias("purchase_count"),
            F.when(bought > 0, exact_mean(spent, bought)).otherwise(F.lit(0.0)).alias("avg_order_value"),
            (bought > 0).alias("is_buyer"),
        )
    )


def stg_users(stg: DataFrame) -> DataFrame:
    """Users with activity and distinct counts.

    Events are first reduced to one row per user, day and purchased product. The two distinct counts,
    which multiply their input rows, then run on the reduced rows.
    """
    bought = F.when(of_type("purchase"), F.col("product_id"))
    daily = stg.groupBy("user_id", "event_date", bought.alias("bought")).agg(*_user_counts())
    totals = ["total_events", "total_views", "total_carts", "total_purchases", "cents"]
    users = daily.groupBy("user_id").agg(
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        *[F.sum(c).alias(c) for c in totals],
        F.count_distinct("bought").alias("unique_products_purchased"),
        F.count_distinct("event_date").alias("active_days"),
    )
    orders = F.col("total_purchases")
    return users.select(
        "user_id",
        "first_seen",
        "last_seen",
        F.datediff("last_seen", "first_seen").alias("days_active"),
        "total_events",
        "total_views",
        "total_carts",
        "total_purchases",
        from_cents(F.col("cents")).alias("total_spent"),
        "unique_products_purchased",
        "active_days",
        (orders > 0).alias("is_buyer"),
        F.when(orders > 0, mean_cents(F.col("cents"), orders)).otherwise(F.lit(0.0)).alias("avg_order_value"),
        ratio(F.col("total_events"), F.col("active_days"), 2).alias("avg_events_per_day"),
        percent(F.col("total_carts"), F.col("total_views")).alias("view_to_cart_rate"),
        percent(orders, F.col("total_carts")).alias("cart_to_purchase_rate"),
    )
