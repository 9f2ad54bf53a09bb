"""Key dedupe of redelivered rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

EVENT_KEY = ["event_time", "event_type", "product_id", "user_id", "user_session"]


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the largest by `order`, ties broken by the remaining columns.

    Spark limits a first-row-per-key window before the shuffle as well, so a key whose copies are a large
    share of all rows reaches its task as one row per input partition.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in [*order, *rest]])
    return df.withColumn("nth", F.row_number().over(newest)).where(F.col("nth") == 1).drop("nth")


def any_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, whichever comes first."""
    return df.dropDuplicates(keys)
