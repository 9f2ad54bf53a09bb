"""Incremental loads by batch id: which batches have been taken in, whenever they arrived.

A high-water mark skips a batch that arrives after a later one. The ledger lists the batches that were merged, so
whatever it does not list is new, in any order of arrival. The rows of a batch are merged before the batch is entered; after
a failure between the two they are merged again, which changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.operators.merge import merge_into
from cartwright.session import materialise, read_if_written, scratch_scope

BATCH = "_batch_id"


def unlisted(source: DataFrame, ledger: DataFrame | None, column: str = BATCH) -> DataFrame:
    """The rows of batches that the ledger does not list. Rows without a batch id are always taken; the merge is keyed."""
    if ledger is None:
        return source
    return source.join(ledger.select(column).distinct(), column, "left_anti").select(*source.columns)


def load_new_batches(
    spark: SparkSession,
    source: DataFrame,
    model: Callable[[DataFrame], DataFrame],
    path: str,
    ledger_path: str,
    key: str,
    order: str,
    partition: str,
) -> None:
    """Runs `model` over the rows of new batches, merges them by `key` into the table at `path` and enters the batches."""
    with scratch_scope(spark):
        ledger = read_if_written(spark, ledger_path)
        new = materialise(unlisted(source, ledger), "new-batches")
        merge_into(spark, path, model(new), [key], [order], partition)
        entries = new.where(F.col(BATCH).isNotNull()).groupBy(BATCH).agg(
            F.count(F.lit(1)).alias("row_count"), F.max(order).alias("ingested_at")
        )
        entries.write.mode("append").parquet(ledger_path)
