"""Structured Streaming forms of the incremental clean and of the monthly summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.operators.dedupe import EVENT_KEY, latest_per_key
from cartwright.operators.merge import merge_into
from cartwright.plans.reports import monthly_sales_state, read_monthly_sales
from cartwright.plans.silver import valid_events


FILES_PER_BATCH = 10_000
SUMMARY_KEY = ["sale_year", "sale_month", "category_level1"]


def run_event_merge(
    spark: SparkSession, landing: str, schema: T.StructType, table: str, checkpoint: str, files: int = FILES_PER_BATCH
) -> None:
    """Merges everything that landed since the last run into the event table at `table`.

    The table keeps the latest delivery of each valid event by day. The merge is keyed and compares
    ingestion times, so late rows are taken in and a replayed micro-batch changes nothing. A long backlog is
    taken in batches of `files` files.
    """

    def merge(batch: DataFrame, _: int) -> None:
        deduplicated = latest_per_key(valid_events(batch), EVENT_KEY, ["_ingestion_time"])
        merge_into(batch.sparkSession, table, deduplicated, EVENT_KEY, ["_ingestion_time"], "event_date")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(landing)
    query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def run_monthly_sales(spark: SparkSession, landing: str, schema: T.StructType, table: str, checkpoint: str) -> None:
    """Keeps the monthly summary of arriving daily sales rows.

    The state has one row per month and category. Update mode hands over the rows that a micro-batch has changed; they
    replace those of their month and category at `table`, of which only the months that are touched are written. A
    replayed micro-batch hands over the same rows again and changes nothing.
    """
    stream = spark.readStream.schema(schema).parquet(landing)
    state = monthly_sales_state(stream)

    def replace(changed: DataFrame, batch: int) -> None:
        month = F.format_string("%04d-%02d", F.col("sale_year"), F.col("sale_month"))
        merge_into(changed.sparkSession, table, changed.withColumns({"month": month, "batch": F.lit(batch)}), SUMMARY_KEY, ["batch"], "month")

    query = (
        state.writeStream.outputMode("update")
        .foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_monthly_summary(spark: SparkSession, table: str) -> DataFrame:
    return read_monthly_sales(spark.read.parquet(table).drop("month", "batch"))
