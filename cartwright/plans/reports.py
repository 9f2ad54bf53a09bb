"""Reports over the gold tables.

Report tables are tiny next to events; ranked reports carry a tie-break so that equal values keep one order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.functions import events as ev
from cartwright.functions import segments as sg
from cartwright.functions.money import from_cents, mean_cents, percent, ratio, readable_quantity, to_cents
from cartwright.plans.gold import PRODUCT_KEY

# Limits of the sales quality flags.
HIGH_ORDER_VALUE = 5000
LOW_ORDER_VALUE = 5
RATE_UNITS = 10_000


def _cents(column: str) -> Column:
    return F.sum(to_cents(F.col(column)))


def _mean_rate(column: str, scale: int) -> Column:
    """Average of a rate with at most four decimals, summed in exact units."""
    units = F.floor(F.col(column) * F.lit(float(RATE_UNITS)) + F.lit(0.5))
    return ratio(F.sum(units), F.count(column) * RATE_UNITS, scale)


def _mean_money(column: str) -> Column:
    return mean_cents(_cents(column), F.count(column))


# --- revenue ---------------------------------------------------------------------------------------


def revenue_by_month(sales: DataFrame) -> DataFrame:
    grouped = sales.groupBy("sale_year", "sale_month").agg(
        _cents("total_revenue").alias("cents"), F.sum("order_count").alias("orders")
    )
    return grouped.select(
        "sale_year",
        "sale_month",
        readable_quantity(from_cents(F.col("cents"))).alias("total_revenue"),
        readable_quantity(F.col("orders")).alias("total_orders"),
        mean_cents(F.col("cents"), F.col("orders")).alias("avg_order_value"),
    )


def readable_totals(sales: DataFrame) -> DataFrame:
    """Revenue and orders per category next to their readable form."""
    grouped = sales.groupBy("category_level1").agg(
        from_cents(_cents("total_revenue")).alias("revenue"), F.sum("order_count").alias("orders")
    )
    return grouped.withColumns(
        {"revenue_text": readable_quantity(F.col("revenue")), "orders_text": readable_quantity(F.col("orders"))}
    )


def top_categories(sales: DataFrame, limit: int = 10) -> DataFrame:
    grouped = sales.groupBy("category_level1", "category_level2").agg(
        _cents("total_revenue").alias("cents"), F.sum("order_count").alias("orders")
    )
    return (
        grouped.orderBy(F.col("cents").desc(), "category_level1", "category_level2")
        .limit(limit)
        .select(
            "category_level1",
            "category_level2",
            from_cents(F.col("cents")).alias("revenue"),
            "orders",
            mean_cents(F.col("cents"), F.col("orders")).alias("aov"),
        )
    )


def revenue_last_days(sales: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    return (
        sales.where(F.col("event_date") >= F.date_sub(as_of, days))
        .groupBy(F.col("event_date").alias("sale_date"))
        .agg(from_cents(_cents("total_revenue")).alias("daily_revenue"), F.sum("order_count").alias("daily_orders"))
    )


def last_sale_date(sales: DataFrame) -> Column:
    return sales.agg(F.max("event_date")).scalar()


def revenue_trend(sales: DataFrame) -> DataFrame:
    return sales.groupBy(F.col("event_date").alias("sale_date")).agg(
        from_cents(_cents("total_revenue")).alias("revenue")
    )


def revenue_by_weekday(sales: DataFrame) -> DataFrame:
    day = F.col("event_date")
    return sales.groupBy(
        (F.weekday(day) + 1).alias("day_of_week"), F.date_format(day, "EEEE").alias("day_name")
    ).agg(
        from_cents(_cents("total_revenue")).alias("revenue"),
        _mean_money("total_revenue").alias("avg_daily_revenue"),
    )


def revenue_by_category(sales: DataFrame) -> DataFrame:
    return sales.groupBy("category_level1").agg(from_cents(_cents("total_revenue")).alias("revenue"))


def monthly_stats(sales: DataFrame) -> DataFrame:
    return sales.groupBy("sale_year", "sale_month").agg(
        F.count("*").alias("days_with_data"),
        F.sum("order_count").alias("total_orders"),
        from_cents(_cents("total_revenue")).alias("total_revenue"),
    )


def monthly_trend(sales: DataFrame, first: str, before: str) -> DataFrame:
    """Orders and revenue by month label over the half-open range from `first` to `before`."""
    day = F.col("event_date")
    chosen = sales.where((day >= F.to_date(F.lit(first))) & (day < F.to_date(F.lit(before))))
    return chosen.groupBy(F.date_format(day, "yyyy-MM").alias("month")).agg(
        F.sum("order_count").alias("orders"), from_cents(_cents("total_revenue")).alias("revenue")
    )


def week_over_week(sales: DataFrame) -> DataFrame:
    """Weekly revenue and its growth. The window sorts one row per week."""
    weeks = sales.groupBy(ev.week_start(F.col("event_date")).alias("week_start")).agg(
        _cents("total_revenue").alias("cents")
    )
    previous = F.lag("cents").over(Window.orderBy("week_start"))
    grown = weeks.withColumn("previous", previous)
    return grown.select(
        "week_start",
        from_cents(F.col("cents")).alias("weekly_revenue"),
        from_cents(F.col("previous")).alias("prev_week_revenue"),
        percent(F.col("cents") - F.col("previous"), F.col("previous")).alias("wow_growth_pct"),
    )


def table_profile(sales: DataFrame) -> DataFrame:
    return sales.agg(
        F.count("*").alias("total_records"),
        F.count_distinct("event_date").alias("unique_dates"),
        F.min("event_date").alias("min_date"),
        F.max("event_date").alias("max_date"),
        from_cents(_cents("total_revenue")).alias("total_revenue"),
    )


def stg_daily_sales(sales: DataFrame) -> DataFrame:
    """Daily sales annotated with revenue per order and orders per customer."""
    return sales.select(
        "event_date",
        "category_level1",
        "category_level2",
        "order_count",
        "unique_customers",
        "unique_products",
        "total_revenue",
        "avg_order_value",
        "sale_year",
        "sale_month",
        mean_cents(to_cents(F.col("total_revenue")), F.col("order_count")).alias("revenue_per_order"),
        ratio(F.col("order_count"), F.col("unique_customers"), 2).alias("orders_per_customer"),
    )


def sales_quality_flags(sales: DataFrame) -> DataFrame:
    """Days and categories with a suspicious average order value."""
    cents, orders = to_cents(F.col("total_revenue")), F.col("order_count")
    flag = (
        F.when((cents == 0) & (orders > 0), "ISSUE: Zero revenue")
        .when(cents > orders * (HIGH_ORDER_VALUE * 100), "High AOV")
        .when(cents < orders * (LOW_ORDER_VALUE * 100), "Low AOV")
        .otherwise("Normal")
    )
    flagged = sales.select(
        "event_date",
        "category_level1",
        "category_level2",
        "order_count",
        "total_revenue",
        mean_cents(cents, orders).alias("avg_order_value"),
        flag.alias("quality_flag"),
    )
    return flagged.where(F.col("quality_flag") != "Normal")


def dashboard_filter(sales: DataFrame, as_of: Column, categories: list[str], days: int = 30) -> DataFrame:
    """The dashboard's relative time range and category selection."""
    return sales.where((F.col("event_date") >= F.date_sub(as_of, days)) & F.col("category_level1").isin(categories))


# --- funnel ----------------------------------------------------------------------------------------


def funnel_latest(funnel: DataFrame, days: int = 30) -> DataFrame:
    return (
        funnel.orderBy(F.col("event_date").desc())
        .limit(days)
        .select(
            F.col("event_date").alias("analysis_date"),
            "views",
            "carts",
            "purchases",
            "view_to_cart_rate",
            "cart_to_purchase_rate",
            "overall_conversion_rate",
        )
    )


def avg_conversion_rates(funnel: DataFrame) -> DataFrame:
    return funnel.agg(
        _mean_rate("view_to_cart_rate", 2).alias("avg_view_to_cart"),
        _mean_rate("cart_to_purchase_rate", 2).alias("avg_cart_to_purchase"),
        _mean_rate("overall_conversion_rate", 4).alias("avg_overall_conversion"),
        _mean_money("avg_revenue_per_purchaser").alias("avg_revenue_per_purchaser"),
    )


def funnel_by_month(funnel: DataFrame) -> DataFrame:
    totals = funnel.groupBy("analysis_year", "analysis_month").agg(
        F.sum("views").alias("total_views"),
        F.sum("carts").alias("total_carts"),
        F.sum("purchases").alias("total_purchases"),
    )
    return totals.withColumns(
        {
            "view_to_cart_rate": percent(F.col("total_carts"), F.col("total_views")),
            "cart_to_purchase_rate": percent(F.col("total_purchases"), F.col("total_carts")),
        }
    )


def funnel_stages(funnel: DataFrame) -> DataFrame:
    """The stages as rows, from one pass over the funnel."""
    totals = funnel.agg(F.sum("views").alias("Views"), F.sum("carts").alias("Carts"), F.sum("purchases").alias("Purchases"))
    return totals.unpivot([], ["Views", "Carts", "Purchases"], "stage", "count")


def stg_funnel_analysis(funnel: DataFrame) -> DataFrame:
    return funnel.withColumn("funnel_health", sg.funnel_health(F.col("overall_conversion_rate")))


# --- customers -------------------------------------------------------------------------------------


def segment_distribution(customers: DataFrame) -> DataFrame:
    """Customers per segment with their share; the window runs over one row per segment."""
    grouped = customers.groupBy("customer_segment").agg(
        F.count("*").alias("customer_count"),
        _mean_money("monetary").alias("avg_monetary"),
        ratio(F.sum("frequency"), F.count("*"), 1).alias("avg_frequency"),
        ratio(F.sum("recency"), F.count("*"), 1).alias("avg_recency"),
    )
    everyone = F.sum("customer_count").over(Window.partitionBy())
    return grouped.select(
        "customer_segment",
        "customer_count",
        percent(F.col("customer_count"), everyone).alias("percentage"),
        "avg_monetary",
        "avg_frequency",
        "avg_recency",
    )


def customers_by_segment(customers: DataFrame) -> DataFrame:
    return customers.groupBy("customer_segment").agg(F.count("*").alias("customers"))


def top_champions(customers: DataFrame, limit: int = 20) -> DataFrame:
    return (
        customers.where(F.col("customer_segment") == "Champions")
        .orderBy(F.col("monetary").desc(), "user_id")
        .limit(limit)
        .select("user_id", "customer_segment", "rfm_score", "monetary", "frequency", "recency", "avg_order_value")
    )


def at_risk_customers(customers: DataFrame, limit: int = 50) -> DataFrame:
    return (
        customers.where(F.col("customer_segment").isin(sg.AT_RISK_SEGMENTS))
        .orderBy(F.col("monetary").desc(), "user_id")
        .limit(limit)
        .select("user_id", "customer_segment", "monetary", "frequency", "recency", "last_purchase_date")
    )


def rfm_score_hist(customers: DataFrame) -> DataFrame:
    return customers.groupBy("rfm_score").agg(
        F.count("*").alias("customer_count"),
        from_cents(_cents("monetary")).alias("total_revenue"),
        _mean_money("monetary").alias("avg_monetary"),
    )


def stg_customer_rfm(customers: DataFrame) -> DataFrame:
    return customers.withColumn("action_recommendation", sg.action_recommendation(F.col("customer_segment")))


# --- products --------------------------------------------------------------------------------------


def top_products(performance: DataFrame, limit: int = 20) -> DataFrame:
    """Best products by revenue with their dense rank.

    The rank of a row only depends on rows with more revenue. Those are among the first `limit` rows, so
    the rank window sorts `limit` rows and the whole table is only searched for its top rows.
    """
    best = performance.orderBy(F.col("total_revenue").desc(), *PRODUCT_KEY).limit(limit)
    rank = F.dense_rank().over(Window.orderBy(F.col("total_revenue").desc()))
    return best.select(
        "product_id",
        "brand",
        "category_level1",
        "purchases",
        "total_revenue",
        "purchase_rate",
        rank.alias("revenue_rank"),
    )


def optimisation_candidates(
    performance: DataFrame, min_views: int = 1000, max_purchase_rate: float = 0.5, limit: int = 20
) -> DataFrame:
    """Products that are viewed often and bought rarely."""
    return (
        performance.where((F.col("views") > min_views) & (F.col("purchase_rate") < max_purchase_rate))
        .orderBy(F.col("views").desc(), *PRODUCT_KEY)
        .limit(limit)
        .select(
            "product_id", "brand", "category_level1", "views", "purchases", "purchase_rate", "cart_to_purchase_rate"
        )
    )


def category_performance(performance: DataFrame) -> DataFrame:
    grouped = performance.groupBy("category_level1").agg(
        F.count("*").alias("product_count"),
        F.sum("views").alias("total_views"),
        F.sum("purchases").alias("total_purchases"),
        from_cents(_cents("total_revenue")).alias("total_revenue"),
    )
    return grouped.withColumn("avg_purchase_rate", percent(F.col("total_purchases"), F.col("total_views"), 4))


def brand_performance(performance: DataFrame, limit: int = 20) -> DataFrame:
    grouped = (
        performance.where(F.col("brand") != ev.UNKNOWN_BRAND)
        .groupBy("brand")
        .agg(
            F.count("*").alias("product_count"),
            F.sum("purchases").alias("total_purchases"),
            from_cents(_cents("total_revenue")).alias("total_revenue"),
            _mean_rate("purchase_rate", 4).alias("avg_purchase_rate"),
        )
    )
    return grouped.orderBy(F.col("total_revenue").desc(), "brand").limit(limit)


# --- traffic and key figures -----------------------------------------------------------------------


def hourly_pattern(traffic: DataFrame) -> DataFrame:
    return traffic.groupBy("event_hour").agg(
        F.sum("event_count").alias("total_events"),
        F.sum("unique_users").alias("unique_users"),
        from_cents(_cents("revenue")).alias("revenue"),
    )


def event_type_counts(events: DataFrame) -> DataFrame:
    """Events per type with their share; the window runs over one row per type."""
    grouped = events.groupBy("event_type").agg(F.count("*").alias("event_count"))
    everything = F.sum("event_count").over(Window.partitionBy())
    return grouped.withColumn("percentage", percent(F.col("event_count"), everything, 1))


def event_profile(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count("*").alias("total_records"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("product_id").alias("unique_products"),
    )


def kpi_summary(sales: DataFrame, customers: DataFrame, funnel: DataFrame) -> DataFrame:
    """One row of key figures: one aggregate per table, put side by side as scalar subqueries."""
    revenue = sales.agg(
        F.struct(
            from_cents(_cents("total_revenue")).alias("total_revenue"),
            F.sum("order_count").alias("total_orders"),
            mean_cents(_cents("total_revenue"), F.sum("order_count")).alias("avg_order_value"),
        )
    )
    people = customers.agg(
        F.struct(
            F.count("*").alias("total_customers"),
            F.count_if(F.col("customer_segment") == "Champions").alias("champion_customers"),
            _mean_money("monetary").alias("avg_customer_ltv"),
        )
    )
    conversion = funnel.agg(
        F.struct(
            _mean_rate("overall_conversion_rate", 4).alias("avg_conversion_rate"),
            _mean_rate("cart_to_purchase_rate", 2).alias("avg_cart_conversion"),
        )
    )
    row = sales.sparkSession.range(1).select(
        revenue.scalar().alias("revenue"), people.scalar().alias("people"), conversion.scalar().alias("conversion")
    )
    return row.select("revenue.*", "people.*", "conversion.*")


def kpi_cards(sales: DataFrame, customers: DataFrame, funnel: DataFrame) -> DataFrame:
    """The dashboard cards. The conversion card scales a percentage by 100 once more, as published."""
    revenue = sales.agg(
        F.struct(
            from_cents(_cents("total_revenue")).alias("total_revenue"), F.sum("order_count").alias("total_orders")
        )
    )
    units = F.floor(F.col("overall_conversion_rate") * F.lit(float(RATE_UNITS)) + F.lit(0.5))
    conversion = funnel.agg(ratio(F.sum(units) * 100, F.count("overall_conversion_rate") * RATE_UNITS, 2))
    row = sales.sparkSession.range(1).select(
        revenue.scalar().alias("revenue"),
        conversion.scalar().alias("avg_conversion_rate"),
        customers.agg(F.count("*")).scalar().alias("total_customers"),
    )
    return row.select("revenue.*", "avg_conversion_rate", "total_customers")


# --- insert-maintained summaries -------------------------------------------------------------------


def monthly_sales_state(sales: DataFrame) -> DataFrame:
    """Additive monthly summary. Customers are summed over days, so a returning customer counts again."""
    return sales.groupBy("sale_year", "sale_month", "category_level1").agg(
        F.sum("order_count").alias("total_orders"),
        F.sum("unique_customers").alias("total_customers"),
        _cents("total_revenue").alias("revenue_cents"),
    )


def merge_monthly_sales(state: DataFrame, increment: DataFrame) -> DataFrame:
    """Adds two states; equals the state of all rows together."""
    both = state.unionByName(increment)
    return both.groupBy("sale_year", "sale_month", "category_level1").agg(
        *[F.sum(c).alias(c) for c in ("total_orders", "total_customers", "revenue_cents")]
    )


def read_monthly_sales(state: DataFrame) -> DataFrame:
    return state.withColumn("total_revenue", from_cents(F.col("revenue_cents"))).drop("revenue_cents")


def segment_state(customers: DataFrame) -> DataFrame:
    """Additive segment summary: averages are kept as sums and divided when read."""
    return customers.groupBy("customer_segment").agg(
        F.count("*").alias("customer_count"),
        _cents("monetary").alias("revenue_cents"),
        F.sum("recency").alias("recency_sum"),
        F.sum("frequency").alias("frequency_sum"),
    )


def merge_segments(state: DataFrame, increment: DataFrame) -> DataFrame:
    sums = ("customer_count", "revenue_cents", "recency_sum", "frequency_sum")
    return state.unionByName(increment).groupBy("customer_segment").agg(*[F.sum(c).alias(c) for c in sums])


def read_segments(state: DataFrame) -> DataFrame:
    count = F.col("customer_count").cast("double")
    return state.select(
        "customer_segment",
        "customer_count",
        from_cents(F.col("revenue_cents")).alias("total_revenue"),
        (F.col("recency_sum").cast("double") / count).alias("avg_recency"),
        (F.col("frequency_sum").cast("double") / count).alias("avg_frequency"),
    )
