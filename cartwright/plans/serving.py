"""Typed serving copies of the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.sources.schemas import AUDIT, SERVING

# Month partition source, sort key and bloom-filter column of each serving table.
SERVING_LAYOUT = {
    "daily_sales": ("sale_date", ["sale_date", "category_level1", "category_level2"], "category_level1"),
    "funnel_analysis": ("analysis_date", ["analysis_date"], None),
    "customer_rfm": (None, ["customer_segment", "rfm_score", "user_id"], "customer_segment"),
    "product_performance": (None, ["category_level1", "revenue_rank", "product_id"], "brand"),
}


def serve(gold: DataFrame, table: str) -> DataFrame:
    """Columns of `gold` renamed and cast to the serving contract.

    A table that was not written yet, and so has no audit time, gets the time of the copy.
    """
    if AUDIT not in gold.columns:
        gold = gold.withColumn(AUDIT, F.current_timestamp())
    return gold.select(*[F.col(source).cast(kind).alias(name) for name, source, kind in SERVING[table]])
