"""Streaming dedupe with state that a watermark bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cartwright.operators.dedupe import EVENT_KEY
from cartwright.plans.silver import valid_events
from cartwright.streaming.incremental import FILES_PER_BATCH

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start_event_dedupe(
    spark: SparkSession, landing: str, schema: T.StructType, table: str, checkpoint: str, delay: str, files: int = FILES_PER_BATCH
) -> StreamingQuery:
    """A stream that appends the first delivery of each valid event to the parquet table at `table`.

    The state store keeps a key until events are `delay` newer than it, on disk (RocksDB), so its size follows the
    events of one delay and not those of all time. Events older than the watermark are not taken up; `late_events` lists
    them. After a stop the stream goes on from its checkpoint: the sink lists the files of finished batches, so a batch
    that is run again does not appear twice.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(landing)
    kept = valid_events(stream).withWatermark("event_time", delay).dropDuplicatesWithinWatermark(EVENT_KEY)
    writer = kept.writeStream.format("parquet").outputMode("append").partitionBy("event_date")
    writer = writer.option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    # A stream takes the setting over when it starts, and keeps it in its checkpoint.
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return writer.start()
    finally:
        spark.conf.set(PROVIDER, before)


def run_event_dedupe(
    spark: SparkSession, landing: str, schema: T.StructType, table: str, checkpoint: str, delay: str, files: int = FILES_PER_BATCH
) -> int:
    """Takes everything that has landed; the number of rows of the last batches that came too late, as Spark counts them."""
    query = start_event_dedupe(spark, landing, schema, table, checkpoint, delay, files)
    query.awaitTermination()
    return sum(operator["numRowsDroppedByWatermark"] for p in query.recentProgress for operator in p["stateOperators"])


def late_events(landed: DataFrame, table: DataFrame) -> DataFrame:
    """The landed valid events that the stream did not take up: one row per key, with the number of deliveries.

    That is an exact list whatever happened to the stream in between, as an event is either in the table or late.
    """
    copies = valid_events(landed).groupBy(*EVENT_KEY).agg(F.count(F.lit(1)).alias("deliveries"))
    left, right = copies.alias("l"), table.select(*EVENT_KEY).alias("r")
    same = F.lit(True)
    for column in EVENT_KEY:
        same = same & F.col(f"l.{column}").eqNullSafe(F.col(f"r.{column}"))
    return left.join(right, same, "left_anti").select(*EVENT_KEY, "deliveries")
