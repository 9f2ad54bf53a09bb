"""Declared schemas: the raw event file and the four serving tables."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_EVENT = T.StructType(
    [
        T.StructField("event_time", T.TimestampType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("category_id", T.LongType()),
        T.StructField("category_code", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("user_session", T.StringType()),
    ]
)

MONEY = "decimal(18,2)"
# A rate in percent can pass 999.99 on a quiet day, so rates get more digits than a plain percentage.
RATE = "decimal(18,2)"
FINE_RATE = "decimal(18,4)"

# Fixed value: when a gold table was made; the last column of every serving table.
AUDIT = "_aggregated_at"

# Serving column, source column, type. Unsigned types are widened one step.
SERVING = {
    "daily_sales": [
        ("sale_date", "event_date", "date"),
        ("category_level1", "category_level1", "string"),
        ("category_level2", "category_level2", "string"),
        ("order_count", "order_count", "bigint"),
        ("unique_customers", "unique_customers", "bigint"),
        ("unique_products", "unique_products", "bigint"),
        ("total_revenue", "total_revenue", MONEY),
        ("avg_order_value", "avg_order_value", MONEY),
        ("min_order_value", "min_order_value", MONEY),
        ("max_order_value", "max_order_value", MONEY),
        ("revenue_per_customer", "revenue_per_customer", MONEY),
        ("sale_year", "sale_year", "int"),
        ("sale_month", "sale_month", "smallint"),
        ("sale_quarter", "sale_quarter", "smallint"),
        ("sale_week", "sale_week", "smallint"),
        (AUDIT, AUDIT, "timestamp"),
    ],
    "funnel_analysis": [
        ("analysis_date", "event_date", "date"),
        ("views", "views", "bigint"),
        ("carts", "carts", "bigint"),
        ("purchases", "purchases", "bigint"),
        ("unique_viewers", "unique_viewers", "bigint"),
        ("unique_carters", "unique_carters", "bigint"),
        ("unique_purchasers", "unique_purchasers", "bigint"),
        ("total_revenue", "total_revenue", MONEY),
        ("view_to_cart_rate", "view_to_cart_rate", RATE),
        ("cart_to_purchase_rate", "cart_to_purchase_rate", RATE),
        ("overall_conversion_rate", "overall_conversion_rate", FINE_RATE),
        ("user_view_to_cart_rate", "user_view_to_cart_rate", RATE),
        ("user_cart_to_purchase_rate", "user_cart_to_purchase_rate", RATE),
        ("avg_revenue_per_purchaser", "avg_revenue_per_purchaser", MONEY),
        ("analysis_year", "analysis_year", "int"),
        ("analysis_month", "analysis_month", "smallint"),
        (AUDIT, AUDIT, "timestamp"),
    ],
    "customer_rfm": [
        ("user_id", "user_id", "bigint"),
        ("recency", "recency", "bigint"),
        ("frequency", "frequency", "bigint"),
        ("monetary", "monetary", MONEY),
        ("r_score", "r_score", "smallint"),
        ("f_score", "f_score", "smallint"),
        ("m_score", "m_score", "smallint"),
        ("rfm_score", "rfm_score", "smallint"),
        ("rfm_string", "rfm_string", "string"),
        ("customer_segment", "customer_segment", "string"),
        ("first_purchase_date", "first_purchase_date", "date"),
        ("last_purchase_date", "last_purchase_date", "date"),
        ("avg_order_value", "avg_order_value", MONEY),
        ("unique_products_bought", "unique_products_bought", "bigint"),
        ("segment_date", "segment_date", "date"),
        (AUDIT, AUDIT, "timestamp"),
    ],
    "product_performance": [
        ("product_id", "product_id", "bigint"),
        ("category_level1", "category_level1", "string"),
        ("category_level2", "category_level2", "string"),
        ("brand", "brand", "string"),
        ("views", "views", "bigint"),
        ("carts", "carts", "bigint"),
        ("purchases", "purchases", "bigint"),
        ("total_revenue", "total_revenue", MONEY),
        ("avg_price", "avg_price", MONEY),
        ("unique_users", "unique_users", "bigint"),
        ("cart_rate", "cart_rate", RATE),
        ("purchase_rate", "purchase_rate", FINE_RATE),
        ("cart_to_purchase_rate", "cart_to_purchase_rate", RATE),
        ("revenue_rank", "revenue_rank", "bigint"),
        ("purchase_rank", "purchase_rank", "bigint"),
        (AUDIT, AUDIT, "timestamp"),
    ],
}
