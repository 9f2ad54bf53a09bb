"""Writers: partitioned tables, compaction, CSV export, JDBC and serving copies."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.plans.serving import SERVING_LAYOUT, serve

# Fixed value: how the CSV files spell null, unlike an empty text.
CSV_NULL = "\\N"
JDBC_BATCH_ROWS = 100_000
COMPRESSION = "snappy"
STATUS_SCHEMA = "table_name string, source_rows long, target_rows long, ok boolean, error string"


def write_partitioned(
    df: DataFrame, path: str, *partition_by: str, mode: str = "overwrite", max_records: int = 0
) -> None:
    """Parquet, partitioned by columns; `max_records` limits the rows of a file (0 is no limit).

    The rebalance hint gathers the rows of a partition into few files and lets adaptive execution split a
    partition that holds a large share of the rows over several tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode(mode).option("compression", COMPRESSION).option("maxRecordsPerFile", max_records)
    writer.partitionBy(*partition_by).parquet(path)


def write_clustered(df: DataFrame, path: str, partition_by: list[str], cluster_by: list[str]) -> None:
    """Parquet partitioned by few, large partitions, with the rows of each file sorted by `cluster_by`.

    The rebalance gathers a partition's rows into files of the advisory size, however many tasks made them; the
    longer sort key lets readers skip row groups by `cluster_by`.
    """
    gathered = df.hint("rebalance", *[F.col(c) for c in partition_by])
    gathered.sortWithinPartitions(*partition_by, *cluster_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_small_partitions(df: DataFrame, path: str, *partition_by: str) -> None:
    """Like `write_partitioned`, for tables with a bounded number of rows per partition.

    Every partition is one file, and the files are spread over all cores however small the table is.
    """
    tasks = df.sparkSession.sparkContext.defaultParallelism
    df.repartition(tasks, *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append(df: DataFrame, path: str, *partition_by: str) -> None:
    write_partitioned(df, path, *partition_by, mode="append")


def truncate_and_load(df: DataFrame, path: str, *partition_by: str) -> None:
    write_partitioned(df, path, *partition_by, mode="overwrite")


def compact_sorted(df: DataFrame, path: str, *columns: str) -> None:
    """Rewrites a table clustered by `columns`, in a new place.

    A hash of the row ends the range key, so that rows with one hot value spread over several files.
    """
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    clustered = df.repartitionByRange(*[F.col(c) for c in columns], spread).sortWithinPartitions(*columns)
    clustered.write.mode("overwrite").parquet(path)


def observed_write(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Runs `write` and returns the number of rows it wrote, without a second pass over the source."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def export_csv(df: DataFrame, path: str, columns: Iterable[str] | None = None, single_file: bool = False) -> None:
    """CSV with a header: every value in quotes, quotes doubled, blanks and line breaks kept, null as CSV_NULL.

    Files are written in parallel. `single_file` makes one task write one file; the caller knows how much that is.
    """
    chosen = df.select(*columns) if columns else df
    (
        (chosen.coalesce(1) if single_file else chosen)
        .write.mode("overwrite")
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("nullValue", CSV_NULL)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_exported_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """What `export_csv` wrote, row by row the same."""
    reader = spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True)
    return reader.option("nullValue", CSV_NULL).csv(path)


def jdbc_options(url: str, table: str, driver: str, truncate: bool = True, **extra: str) -> dict[str, str]:
    """Writer options of the bulk load; credentials come from the caller in `extra`."""
    return {
        "url": url,
        "dbtable": table,
        "driver": driver,
        "batchsize": str(JDBC_BATCH_ROWS),
        "isolationLevel": "NONE",
        "truncate": str(truncate).lower(),
        **extra,
    }


def write_jdbc(df: DataFrame, options: dict[str, str], mode: str = "overwrite") -> None:
    df.write.format("jdbc").options(**options).mode(mode).save()


def write_serving(gold: DataFrame, table: str, path: str) -> int:
    """Serving copy of a gold table: sorted files with a bloom filter, by month where the table has one.

    A table without a month is range partitioned by its sort key, so that a file spans few values. A hash of the
    row ends the range key and spreads a hot value over several files. Returns the number of rows written.
    """
    month_of, sort_key, bloom = SERVING_LAYOUT[table]
    served = serve(gold, table)
    partition_by = []
    if month_of:
        served = served.withColumn("month", F.year(month_of) * 100 + F.month(month_of))
        partition_by = ["month"]
        served = served.hint("rebalance", F.col("month"))
    else:
        served = served.repartitionByRange(*sort_key, F.xxhash64(*served.columns))

    def write(laid_out: DataFrame) -> None:
        writer = laid_out.write.mode("overwrite").partitionBy(*partition_by)
        if bloom:
            writer = writer.option(f"parquet.bloom.filter.enabled#{bloom}", "true")
        writer.parquet(path)

    # Counted behind the shuffle: to find the ranges, Spark reads what is before it twice.
    return observed_write(served.sortWithinPartitions(*partition_by, *sort_key), write)


def sync_all(spark: SparkSession, tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Writes each serving copy; a failing table is reported and does not stop the others."""
    status = []
    for name, (gold, path) in tables.items():
        try:
            source_rows = write_serving(gold, name, path)
            target_rows = spark.read.parquet(path).count()
            status.append((name, source_rows, target_rows, source_rows == target_rows, None))
        except Exception as error:
            status.append((name, None, None, False, str(error).splitlines()[0]))
    return spark.createDataFrame(status, STATUS_SCHEMA)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One labelled row count per table."""
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


def reconcile(source: dict[str, DataFrame], target: dict[str, DataFrame]) -> DataFrame:
    """Row counts of source and target side by side."""
    left = row_counts(source).withColumnRenamed("row_count", "source_rows")
    right = row_counts(target).withColumnRenamed("row_count", "target_rows")
    return left.join(right, "table_name", "full").withColumn("matches", F.col("source_rows").eqNullSafe(F.col("target_rows")))
