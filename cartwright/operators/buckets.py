"""Keyed merges into bucketed tables, which do not move the target.

The target is a catalog table partitioned by a column that its key determines and bucketed by the key. A merge joins it with
the batch bucket by bucket: the batch is dealt to the buckets, the target is read where it is, and each task writes the
buckets it has read. Only partitions that the batch touches are read and written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.operators.dedupe import latest_per_key
from cartwright.session import materialise, scratch_scope

#: Partitions of a batch that are listed one by one.
MOST_PARTITIONS = 2000


def create_bucketed(df: DataFrame, table: str, path: str, key: str, partition: str, buckets: int) -> None:
    """The catalog table `table` with the rows of `df`, each bucket of a partition in one file."""
    rows = df.repartition(buckets, key)
    rows.write.mode("overwrite").option("path", path).partitionBy(partition).bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def merged_rows(target: DataFrame, batch: DataFrame, key: str, order: str) -> DataFrame:
    """Per key the row with the larger `order` of either side, that of the target where they are equal.

    With the target bucketed by `key` only the batch is shuffled.
    """
    columns = target.columns
    old = target.select(F.struct(*columns).alias("old"), F.col(key).alias("old_key"))
    new = batch.select(F.struct(*columns).alias("new"), F.col(key).alias("new_key"))
    both = old.join(new.hint("merge"), F.col("old_key") == F.col("new_key"), "full_outer")
    is_new = F.col("old").isNull() | (F.col("new").isNotNull() & (F.col(f"new.{order}") > F.col(f"old.{order}")))
    return both.select(F.when(is_new, F.col("new")).otherwise(F.col("old")).alias("row")).select("row.*")


def merge_bucketed(spark: SparkSession, table: str, batch: DataFrame, key: str, order: str, partition: str) -> None:
    """Merges `batch` into the bucketed `table`. Columns that the batch lacks are null, others are left out.

    Replays change nothing. A row without a key is equal to none and always added.
    """
    target = spark.table(table)
    with scratch_scope(spark):
        batch = latest_per_key(batch, [key], [order])
        missing = {c: F.lit(None).cast(target.schema[c].dataType) for c in target.columns if c not in batch.columns}
        batch = materialise(batch.withColumns(missing).select(*target.columns), "bucket-batch")
        day = F.col(partition)
        low, high, has_null = batch.agg(F.min(day), F.max(day), F.max(day.isNull())).first()
        if has_null is None:
            return
        # Only the partitions listed are read; a batch over very many of them reads all between its first and last.
        days = [r[0] for r in batch.select(day).where(day.isNotNull()).distinct().limit(MOST_PARTITIONS + 1).collect()]
        touched = day.isin(days) if len(days) <= MOST_PARTITIONS else day.between(F.lit(low), F.lit(high))
        rows = merged_rows(target.where(touched | day.isNull() if has_null else touched), batch, key, order)
        before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            rows.select(*target.columns).write.insertInto(table, overwrite=True)
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
