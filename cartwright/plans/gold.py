"""Gold tables: daily sales, conversion funnel, customer segments, hourly traffic and product performance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.functions import events as ev
from cartwright.functions import segments as sg
from cartwright.functions.money import conversion_rate, exact_mean, from_cents, mean_cents, percent, ratio, to_cents
from cartwright.operators.ranking import add_dense_ranks, add_ntiles
from cartwright.plans.silver import count_type, of_type, purchase_cents

SCORE_TILES = 5


def _sales_by_day(events: DataFrame) -> DataFrame:
    """Two distinct counts share one shuffle by group and counted value, so a hot category stays spread."""
    return (
        events.where(of_type("purchase"))
        .groupBy("event_date", "category_level1", "category_level2")
        .agg(
            F.count("*").alias("order_count"),
            F.count_distinct("user_id").alias("unique_customers"),
            F.count_distinct("product_id").alias("unique_products"),
            F.sum(to_cents(F.col("price"))).alias("cents"),
            F.min("price").alias("min_order_value"),
            F.max("price").alias("max_order_value"),
        )
    )


def daily_sales(silver: DataFrame) -> DataFrame:
    """Purchases by day and category, job variant."""
    parts = ev.date_parts(F.col("event_date"), "sale")
    return _sales_by_day(silver).select(
        "event_date",
        "category_level1",
        "category_level2",
        "order_count",
        "unique_customers",
        "unique_products",
        from_cents(F.col("cents")).alias("total_revenue"),
        exact_mean(F.col("cents"), F.col("order_count")).alias("avg_order_value"),
        "min_order_value",
        "max_order_value",
        mean_cents(F.col("cents"), F.col("unique_customers")).alias("revenue_per_customer"),
        *[parts[n].alias(n) for n in ("sale_year", "sale_month", "sale_quarter", "sale_week")],
    )


def fct_daily_sales(stg: DataFrame) -> DataFrame:
    """Purchases by day and category, SQL-model variant."""
    day = F.col("event_date")
    keys = [day, F.col("category_level1"), F.col("category_level2")]
    parts = ev.date_parts(day, "sale")
    shown = ("sale_year", "sale_month", "sale_quarter", "sale_week", "sale_day_of_week")
    return _sales_by_day(stg).select(
        ev.surrogate_key(*keys).alias("sale_id"),
        day.alias("sale_date"),
        "category_level1",
        "category_level2",
        "order_count",
        "unique_customers",
        "unique_products",
        from_cents(F.col("cents")).alias("total_revenue"),
        mean_cents(F.col("cents"), F.col("order_count")).alias("avg_order_value"),
        "min_order_value",
        "max_order_value",
        mean_cents(F.col("cents"), F.col("unique_customers")).alias("revenue_per_customer"),
        ratio(F.col("order_count"), F.col("unique_customers"), 2).alias("orders_per_customer"),
        *[parts[n].alias(n) for n in shown],
        ev.is_weekend(day).alias("is_weekend"),
    )


def _funnel_counts(events: DataFrame) -> DataFrame:
    """Event and user counts per day.

    One row per day and user comes first. Distinct users of a type are then the rows with at least one
    such event, which saves the four-fold row expansion of three distinct counts.
    """
    per_user = events.groupBy("event_date", "user_id").agg(
        count_type("view").alias("views"),
        count_type("cart").alias("carts"),
        count_type("purchase").alias("purchases"),
        purchase_cents().alias("cents"),
    )

    def users_with(count: str) -> Column:
        return F.count_if(F.col("user_id").isNotNull() & (F.col(count) > 0))

    return per_user.groupBy("event_date").agg(
        F.sum("views").alias("views"),
        F.sum("carts").alias("carts"),
        F.sum("purchases").alias("purchases"),
        users_with("views").alias("unique_viewers"),
        users_with("carts").alias("unique_carters"),
        users_with("purchases").alias("unique_purchasers"),
        F.sum("cents").alias("cents"),
    )


def _or_zero(part: Column, whole: Column) -> Column:
    return conversion_rate(part, whole, 2)


def funnel_daily(silver: DataFrame) -> DataFrame:
    """Daily funnel, job variant."""
    return funnel_rates(_funnel_counts(silver))


def funnel_rates(counts: DataFrame) -> DataFrame:
    """Rates of the job variant: those over views are null without views, the others are 0."""
    c = F.col
    day = c("event_date")
    average = F.when(c("unique_purchasers") > 0, mean_cents(c("cents"), c("unique_purchasers"))).otherwise(0.0)
    return counts.select(
        "event_date",
        "views",
        "carts",
        "purchases",
        "unique_viewers",
        "unique_carters",
        "unique_purchasers",
        from_cents(c("cents")).alias("total_revenue"),
        percent(c("carts"), c("views")).alias("view_to_cart_rate"),
        _or_zero(c("purchases"), c("carts")).alias("cart_to_purchase_rate"),
        percent(c("purchases"), c("views"), 4).alias("overall_conversion_rate"),
        percent(c("unique_carters"), c("unique_viewers")).alias("user_view_to_cart_rate"),
        _or_zero(c("unique_purchasers"), c("unique_carters")).alias("user_cart_to_purchase_rate"),
        average.alias("avg_revenue_per_purchaser"),
        F.year(day).alias("analysis_year"),
        F.month(day).alias("analysis_month"),
    )


def fct_funnel(stg: DataFrame) -> DataFrame:
    """Daily funnel, SQL-model variant: every rate is null without its denominator."""
    c = F.col
    day = c("event_date")
    return _funnel_counts(stg).select(
        day.alias("analysis_date"),
        "views",
        "carts",
        "purchases",
        "unique_viewers",
        "unique_carters",
        "unique_purchasers",
        from_cents(c("cents")).alias("total_revenue"),
        percent(c("carts"), c("views")).alias("view_to_cart_rate"),
        percent(c("purchases"), c("carts")).alias("cart_to_purchase_rate"),
        percent(c("purchases"), c("views"), 4).alias("overall_conversion_rate"),
        percent(c("unique_carters"), c("unique_viewers")).alias("user_view_to_cart_rate"),
        percent(c("unique_purchasers"), c("unique_carters")).alias("user_cart_to_purchase_rate"),
        percent(c("unique_purchasers"), c("unique_viewers"), 4).alias("user_overall_conversion_rate"),
        mean_cents(c("cents"), c("unique_purchasers")).alias("avg_revenue_per_purchaser"),
        mean_cents(c("cents"), c("purchases")).alias("avg_order_value"),
        F.year(day).alias("analysis_year"),
        F.month(day).alias("analysis_month"),
    )


def funnel_overall(funnel: DataFrame) -> DataFrame:
    """Totals and ratio-of-sums rates over the whole period."""
    totals = funnel.agg(
        F.sum("views").alias("total_views"),
        F.sum("carts").alias("total_carts"),
        F.sum("purchases").alias("total_purchases"),
    )
    views, carts, purchases = F.col("total_views"), F.col("total_carts"), F.col("total_purchases")
    return totals.select(
        "*",
        percent(carts, views).alias("overall_view_to_cart_pct"),
        percent(purchases, carts).alias("overall_cart_to_purchase_pct"),
        percent(purchases, views, 4).alias("overall_conversion_pct"),
    )


def _customers(events: DataFrame) -> DataFrame:
    return (
        events.where(of_type("purchase"))
        .groupBy("user_id")
        .agg(
            F.count("*").alias("frequency"),
            F.sum(to_cents(F.col("price"))).alias("cents"),
            F.min("event_date").alias("first_purchase_date"),
            F.max("event_date").alias("last_purchase_date"),
            F.count_distinct("product_id").alias("unique_products_bought"),
        )
    )


def last_purchase_date(events: DataFrame) -> Column:
    """The reference date as a scalar subquery."""
    return events.where(of_type("purchase")).agg(F.max("event_date")).scalar()


def rfm_base(silver: DataFrame, reference_date: Column | None = None) -> DataFrame:
    """Recency, frequency and monetary value per purchaser, against the last purchase date of all."""
    reference_date = last_purchase_date(silver) if reference_date is None else reference_date
    return _customers(silver).select(
        "user_id",
        F.datediff(reference_date, "last_purchase_date").alias("recency"),
        "frequency",
        from_cents(F.col("cents")).alias("monetary"),
        "first_purchase_date",
        "last_purchase_date",
        exact_mean(F.col("cents"), F.col("frequency")).alias("avg_order_value"),
        "unique_products_bought",
    )


def rfm_base_asof(stg: DataFrame, as_of: Column) -> DataFrame:
    """Recency, frequency and monetary value per purchaser against a given date, with the lifespan."""
    return _customers(stg).select(
        "user_id",
        F.datediff(as_of, "last_purchase_date").alias("recency"),
        "frequency",
        from_cents(F.col("cents")).alias("monetary"),
        "first_purchase_date",
        "last_purchase_date",
        mean_cents(F.col("cents"), F.col("frequency")).alias("avg_order_value"),
        "unique_products_bought",
        F.datediff("last_purchase_date", "first_purchase_date").alias("customer_lifespan_days"),
    )


def add_rfm_scores(base: DataFrame) -> DataFrame:
    """Quintile scores (5 is best), their sum and their digits; ties go by user.

    A customer without a purchase date has no recency and comes last, which is score 5.
    """
    values = {
        "r_score": -F.col("recency"),
        "f_score": F.col("frequency"),
        "m_score": to_cents(F.col("monetary")),
    }
    scored = add_ntiles(base, SCORE_TILES, values, "user_id")
    r, f, m = (F.col(name) for name in values)
    return scored.withColumns({"rfm_score": r + f + m, "rfm_string": F.concat_ws("", r, f, m)})


def customer_rfm(silver: DataFrame) -> DataFrame:
    """Segmented customers, job variant with eight segments."""
    scored = add_rfm_scores(rfm_base(silver))
    scores = (F.col("r_score"), F.col("f_score"), F.col("m_score"))
    return scored.withColumns(
        {"customer_segment": sg.segment_8(*scores), "segment_date": last_purchase_date(silver)}
    )


def dim_customer_rfm(stg: DataFrame, as_of: Column) -> DataFrame:
    """Segmented customers, SQL-model variant with twelve segments and a contact priority."""
    scored = add_rfm_scores(rfm_base_asof(stg, as_of))
    scores = (F.col("r_score"), F.col("f_score"), F.col("m_score"))
    return scored.select(
        "user_id",
        "recency",
        "frequency",
        "monetary",
        "r_score",
        "f_score",
        "m_score",
        "rfm_score",
        "rfm_string",
        sg.segment_12(*scores).alias("customer_segment"),
        sg.segment_priority(*scores).alias("segment_priority"),
        "first_purchase_date",
        "last_purchase_date",
        "customer_lifespan_days",
        "avg_order_value",
        "unique_products_bought",
        as_of.alias("segment_date"),
    )


def hourly_traffic(silver: DataFrame, compat_weekday: bool = False) -> DataFrame:
    """Traffic by day, hour and event type.

    Reduced to one row per user and session first, so that the two distinct counts expand few rows.
    """
    keys = ["event_date", "event_hour", "event_type"]
    sessions = silver.groupBy(*keys, "user_id", "user_session").agg(
        F.count("*").alias("events"), purchase_cents().alias("cents")
    )
    weekday = ev.day_of_week_compat if compat_weekday else F.dayofweek
    return (
        sessions.groupBy(*keys)
        .agg(
            F.sum("events").alias("event_count"),
            F.count_distinct("user_id").alias("unique_users"),
            F.count_distinct("user_session").alias("unique_sessions"),
            from_cents(F.sum("cents")).alias("revenue"),
        )
        .withColumn("day_of_week", weekday(F.col("event_date")))
    )


PRODUCT_KEY = ["product_id", "category_level1", "category_level2", "brand"]


def product_performance(silver: DataFrame) -> DataFrame:
    """Counters, revenue and zero-safe rates per product, category and brand."""
    grouped = silver.groupBy(*PRODUCT_KEY).agg(
        count_type("view").alias("views"),
        count_type("cart").alias("carts"),
        count_type("purchase").alias("purchases"),
        purchase_cents().alias("revenue_cents"),
        F.sum(to_cents(F.col("price"))).alias("price_cents"),
        F.count("*").alias("events"),
        F.count_distinct("user_id").alias("unique_users"),
    )
    views, carts, purchases = F.col("views"), F.col("carts"), F.col("purchases")
    return grouped.select(
        *PRODUCT_KEY,
        "views",
        "carts",
        "purchases",
        from_cents(F.col("revenue_cents")).alias("total_revenue"),
        exact_mean(F.col("price_cents"), F.col("events")).alias("avg_price"),
        "unique_users",
        conversion_rate(carts, views, 2).alias("cart_rate"),
        conversion_rate(purchases, views, 4).alias("purchase_rate"),
        conversion_rate(purchases, carts, 2).alias("cart_to_purchase_rate"),
    )


def product_ranks(performance: DataFrame) -> DataFrame:
    """Product performance with dense ranks by revenue and by purchases over all products."""
    values = {"revenue_rank": to_cents(F.col("total_revenue")), "purchase_rank": F.col("purchases")}
    return add_dense_ranks(performance, values)
