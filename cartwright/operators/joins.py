"""Fact-to-dimension join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dimension_join(fact: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str) -> DataFrame:
    """Left join of a large fact table with a dimension.

    Spark decides by the size in bytes whether the dimension is sent to all tasks; adaptive execution looks again
    at run time, and splits hot keys where both sides are shuffled.
    """
    return fact.join(dimension, F.col(fact_key) == F.col(dimension_key), "left")
