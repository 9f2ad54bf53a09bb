"""Incremental reads and keyed merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.operators.dedupe import latest_per_key
from cartwright.session import materialise, read_if_written, scratch_scope


# Before any ingestion time, as the mark of an empty target.
LOWEST_MARK = "0001-01-01 00:00:00"


def new_rows(
    source: DataFrame, target: DataFrame, column: str = "_ingestion_time", lowest: str = LOWEST_MARK
) -> DataFrame:
    """Rows of `source` above the target's high-water mark, or above `lowest` when the target is empty.

    The comparison is strict: rows at the mark, and batches that arrive out of order, are not picked up.
    The mark is one scalar subquery, so that the comparison reaches the scan of the source.
    """
    floor = F.lit(lowest).cast(target.schema[column].dataType)
    mark = target.agg(F.coalesce(F.max(column), floor)).scalar()
    return source.where(F.col(column) > mark)


def merge_into(
    spark: SparkSession, path: str, batch: DataFrame, key: list[str], order: list[str], partition: str
) -> None:
    """Merges `batch` into the parquet table at `path`; per key the row with the largest `order` stays.

    The key determines the partition column, so only the partitions that the batch touches are read and rewritten,
    that of null included. The table keeps all of its columns and gains new ones of the batch; where a row lacks
    one, it is null. A batch may hold a key several times. The merge gives the same table when a batch is
    replayed or batches arrive out of order.
    """
    with scratch_scope(spark):
        batch = latest_per_key(batch, key, order)
        table = read_if_written(spark, path)
        merged = batch
        if table is not None:
            batch = materialise(batch, "merge-batch")
            # The bounds prune the scan to the days between, the semi join to the days themselves.
            day = F.col(partition)
            low, high, has_null = batch.agg(F.min(day), F.max(day), F.max(day.isNull())).first()
            if has_null is None:
                return
            between = day.between(F.lit(low), F.lit(high))
            touched = batch.select(partition).where(between).distinct()
            kept = table.where(between).join(touched, partition, "left_semi")
            if has_null:
                kept = kept.unionByName(table.where(day.isNull()).select(*kept.columns))
            both = kept.unionByName(batch, allowMissingColumns=True)
            merged = latest_per_key(both, key, order)
        # Partitions are replaced when all tasks are done, so the files that are read are still there.
        (
            merged.hint("rebalance", F.col(partition))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition)
            .parquet(path)
        )
