"""Readers for event files and tables, and the lineage columns added at ingestion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.session import materialise
from cartwright.sources.commerce import with_partition_columns
from cartwright.sources.schemas import RAW_EVENT


def read_csv_events(spark: SparkSession, path: str, schema: T.StructType | None = RAW_EVENT) -> DataFrame:
    """CSV files with a header, under a declared schema; `path` may be a glob.

    A declared schema saves the extra pass over the files that inference needs. Without one the types are
    inferred.
    """
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def read_csv_events_as_text(spark: SparkSession, path: str) -> DataFrame:
    """Like `read_csv_events`, but reads the event time as text and casts it; bad text becomes null."""
    as_text = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name == "event_time" else f.dataType) for f in RAW_EVENT]
    )
    return read_csv_events(spark, path, as_text).withColumn("event_time", F.col("event_time").try_cast("timestamp"))


REJECTED = "rejected_line"


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All lines of CSV files with a header: the columns of the schema, or null in all of them and the line in `rejected_line`.

    A line is rejected if it has a field too few or too many, or one that is not of its column's type; a
    reader that only casts would turn such fields into null.
    """
    checked = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
    options = {"header": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED, "enforceSchema": True}
    rows = spark.read.schema(checked).options(**options).csv(path)
    good = F.col(REJECTED).isNull()
    return rows.select(*[F.when(good, F.col(f.name)).alias(f.name) for f in schema], REJECTED)


def ingest_checked(spark: SparkSession, path: str, schema: T.StructType, table: str, quarantine: str) -> DataFrame:
    """Appends the good lines to the table and the others, with their file, to the quarantine; both and their sum as counts."""
    rows = read_csv_checked(spark, path, schema).withColumn("source_file", F.col("_metadata.file_path"))
    # Read once: which lines are rejected depends on all columns, which pruning would leave out of a second reading.
    rows = materialise(rows, "checked-lines")
    rows.where(F.col(REJECTED).isNull()).drop(REJECTED, "source_file").write.mode("append").parquet(table)
    rows.where(F.col(REJECTED).isNotNull()).select(REJECTED, "source_file").write.mode("append").parquet(quarantine)
    return rows.agg(F.count_if(F.col(REJECTED).isNull()).alias("kept"), F.count(REJECTED).alias("rejected"), F.count(F.lit(1)).alias("lines"))


def events_from_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """A few hand-written raw events, with partition columns."""
    return with_partition_columns(spark.createDataFrame(rows, RAW_EVENT))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def create_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}")


def write_table(df: DataFrame, name: str, path: str, *partition_by: str) -> None:
    """A catalog table over parquet files at `path`, replaced on each run."""
    df.write.mode("overwrite").option("path", path).partitionBy(*partition_by).saveAsTable(name)


def external_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A table over existing parquet files, without a copy."""
    spark.catalog.createTable(name, path, source="parquet")
    return spark.table(name)


def with_lineage(df: DataFrame, batch_id: str, ingested_at: Column | None = None) -> DataFrame:
    """Ingestion time, source file and batch id of rows read from files."""
    return df.select(
        "*",
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("_ingestion_time"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.lit(batch_id).alias("_batch_id"),
    )


def ingest_csv(spark: SparkSession, path: str, batch_id: str, ingested_at: Column | None = None) -> DataFrame:
    """Raw CSV files as bronze rows."""
    return with_partition_columns(with_lineage(read_csv_events(spark, path), batch_id, ingested_at))


def sample(df: DataFrame, rows: int = 5, *columns: str) -> DataFrame:
    """A few rows to look at."""
    return df.select(*(columns or ["*"])).limit(rows)


def describe_schema(df: DataFrame) -> DataFrame:
    """One row per column: its place, name and type."""
    rows = [(n, field.name, field.dataType.simpleString()) for n, field in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "position long, column_name string, data_type string")
