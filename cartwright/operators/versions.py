"""Reading earlier states of an append-only table, and evolving its schema.

Every row carries the time it was ingested at. The batches of one time are a snapshot, and the table as of a
snapshot or time is the rows up to then, so that earlier states need no copies and no log of their own.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.functions.events import draw

INGESTED = "_ingestion_time"


def snapshot_log(df: DataFrame) -> DataFrame:
    """snapshot_id, parent_id, committed_at, added_records and total_records, one row per ingestion time.

    The windows run over one row per ingestion time.
    """
    added = df.groupBy(F.col(INGESTED).alias("committed_at")).agg(F.count("*").alias("added_records"))
    in_order = Window.orderBy("committed_at")
    return added.select(
        F.row_number().over(in_order).cast("long").alias("snapshot_id"),
        F.lag(F.lit(1)).over(in_order).alias("has_parent"),
        "committed_at",
        "added_records",
        F.sum("added_records").over(in_order).alias("total_records"),
    ).select(
        "snapshot_id",
        F.when(F.col("has_parent").isNotNull(), F.col("snapshot_id") - 1).alias("parent_id"),
        "committed_at",
        "added_records",
        "total_records",
    )


def snapshots(df: DataFrame, limit: int = 10) -> DataFrame:
    """Newest first."""
    log = snapshot_log(df).withColumn("operation", F.lit("append"))
    counts = {c: F.col(c).cast("string") for c in ("added_records", "total_records")}
    return log.withColumns(counts).orderBy(F.col("committed_at").desc()).limit(limit)


def as_of_time(df: DataFrame, time: datetime | Column) -> DataFrame:
    """The rows that were there at a time."""
    return df.where(F.col(INGESTED) <= (time if isinstance(time, Column) else F.lit(time)))


def as_of_snapshot(df: DataFrame, snapshot_id: int) -> DataFrame:
    """The rows that were there after a snapshot; a roll-back to it reads the same rows."""
    log = snapshot_log(df).where(F.col("snapshot_id") == snapshot_id)
    return as_of_time(df, log.agg(F.max("committed_at")).scalar())


def history(df: DataFrame, current: int | None = None) -> DataFrame:
    """Snapshots with a flag for the current one (the last by default) and its ancestors."""
    log = snapshot_log(df)
    reached = F.lit(True) if current is None else F.col("snapshot_id") <= current
    return log.select(
        F.col("committed_at").alias("made_current_at"), "snapshot_id", "parent_id", reached.alias("is_current_ancestor")
    )


def commit_log(df: DataFrame, parents: dict[int, int | None]) -> DataFrame:
    """The snapshots of a table whose history has branches: `parents` names the parent of those that do not follow the one before."""
    log = snapshot_log(df).select("snapshot_id", "parent_id", "committed_at", "added_records")
    for snapshot_id, parent_id in parents.items():
        parent = F.when(F.col("snapshot_id") == snapshot_id, F.lit(parent_id).cast("long")).otherwise(F.col("parent_id"))
        log = log.withColumn("parent_id", parent)
    return log


def ancestors(log: DataFrame, current: int) -> DataFrame:
    """snapshot_id of `current` and of its parents up to the first, by walking the log."""
    return log.sparkSession.sql(
        """WITH RECURSIVE chain(snapshot_id, parent_id) AS (
            SELECT snapshot_id, parent_id FROM {log} WHERE snapshot_id = {current}
            UNION ALL
            SELECT l.snapshot_id, l.parent_id FROM {log} l JOIN chain c ON l.snapshot_id = c.parent_id
        ) SELECT snapshot_id FROM chain""",
        log=log,
        current=int(current),
    )


def branched_history(log: DataFrame, current: int) -> DataFrame:
    """Snapshots with a flag for the current one and its ancestors; one on a branch that was rolled back is none."""
    reached = ancestors(log, current).select(F.col("snapshot_id").alias("reached"))
    marked = log.join(reached, F.col("snapshot_id") == F.col("reached"), "left")
    return marked.select(
        F.col("committed_at").alias("made_current_at"), "snapshot_id", "parent_id", "added_records", F.col("reached").isNotNull().alias("is_current_ancestor")
    )


def read_branch(df: DataFrame, log: DataFrame, current: int) -> DataFrame:
    """The rows that a reader sees when `current` is the current snapshot: those of its chain, none of abandoned snapshots."""
    chain = log.join(ancestors(log, current), "snapshot_id").select(F.col("committed_at").alias("on_chain"))
    return df.join(chain, F.col(INGESTED) == F.col("on_chain"), "left_semi")


def catalog_table_as_of(
    spark: SparkSession, table: str, snapshot_id: int | None = None, timestamp: str | None = None
) -> DataFrame:
    """The same reads on a catalog whose tables support time travel."""
    if snapshot_id is not None:
        return spark.read.option("versionAsOf", snapshot_id).table(table)
    if timestamp is not None:
        return spark.read.option("timestampAsOf", timestamp).table(table)
    return spark.table(table)


def compare_counts(older: DataFrame, current: DataFrame) -> DataFrame:
    """Row counts of two versions as labelled rows."""

    def count(label: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("row_count")).select(F.lit(label).alias("version"), "row_count")

    return count("older", older).unionByName(count("current", current))


def diff_rows(older: DataFrame, current: DataFrame) -> DataFrame:
    """Rows added and removed between two versions, duplicates counted.

    Equal rows are counted before the shuffle, with +1 and -1 per version, so a row with many copies
    costs one record per task.
    """
    columns = older.columns
    signed = current.select(*columns, F.lit(1).alias("sign")).unionByName(older.select(*columns, F.lit(-1).alias("sign")))
    change = signed.groupBy(*columns).agg(F.sum("sign").alias("copies")).where(F.col("copies") != 0)
    return change.select(
        *columns,
        F.when(F.col("copies") > 0, "added").otherwise("removed").alias("change"),
        F.abs("copies").alias("copies"),
    )


def add_column(df: DataFrame, name: str, data_type: str, comment: str = "") -> DataFrame:
    """Adds a null column with a comment; a second call changes nothing."""
    if name in df.columns:
        return df
    return df.withColumn(name, F.lit(None).cast(data_type)).withMetadata(name, {"comment": comment} if comment else {})


def add_table_column(spark: SparkSession, table: str, name: str, data_type: str, comment: str = "") -> bool:
    """Adds a column to a catalog table; false when it is already there."""
    if name in spark.table(table).columns:
        return False
    text = comment.replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({name} {data_type} COMMENT '{text}')")
    return True


def schema_changes(spark: SparkSession, before: T.StructType, after: T.StructType) -> DataFrame:
    """One row per column: old type, new type and what happened."""
    old = {f.name: f.dataType.simpleString() for f in before}
    new = {f.name: f.dataType.simpleString() for f in after}
    rows = []
    for name in dict.fromkeys([*old, *new]):
        if name not in old:
            change = "added"
        elif name not in new:
            change = "dropped"
        else:
            change = "kept" if old[name] == new[name] else "retyped"
        rows.append((name, old.get(name), new.get(name), change))
    return spark.createDataFrame(rows, "column_name string, old_type string, new_type string, change string")


def schema_change_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """`schema_changes` with the number of values in each column before and after, null where the column is not there."""

    def counts(df: DataFrame, name: str) -> DataFrame:
        entries = [F.struct(F.lit(c).alias("counted"), F.count(c).alias(name)) for c in df.columns]
        return df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))

    changes = schema_changes(before.sparkSession, before.schema, after.schema)
    for df, name in ((before, "old_values"), (after, "new_values")):
        changes = changes.join(counts(df, name), F.col("column_name") == F.col("counted"), "left").drop("counted")
    return changes


def reshape(
    df: DataFrame,
    rename: dict[str, str] | None = None,
    drop: list[str] | None = None,
    cast: dict[str, str] | None = None,
    first: list[str] | None = None,
) -> DataFrame:
    """Renames, drops, retypes and reorders columns of a new version."""
    df = df.withColumnsRenamed(rename or {}).drop(*(drop or []))
    df = df.withColumns({name: F.col(name).cast(kind) for name, kind in (cast or {}).items()})
    front = first or []
    return df.select(*front, *[c for c in df.columns if c not in front])


FIELD_ID, READ_BY_ID = "parquet.field.id", "spark.sql.parquet.fieldId.read.enabled"


def with_field_ids(df: DataFrame, ids: dict[str, int]) -> DataFrame:
    """The columns listed, each with an identity that files keep whatever its name is."""
    return df.select(*[F.col(name).alias(name, metadata={FIELD_ID: number}) for name, number in ids.items()])


def read_by_id(spark: SparkSession, paths: list[str], schema: T.StructType, ids: dict[str, int]) -> DataFrame:
    """Files of several versions of a table under the names and types of `schema`, without rewriting old files.

    Columns are found by identity: a renamed column is read from old files, one that files lack is null, and a whole
    number that was widened is read from either width. The session matches columns by identity from then on, wherever
    a schema has identities.
    """
    spark.conf.set(READ_BY_ID, True)
    fields = [T.StructField(f.name, f.dataType, True, {FIELD_ID: ids[f.name]}) for f in schema if f.name in ids]
    return spark.read.schema(T.StructType(fields)).parquet(*paths)


def backfill(df: DataFrame, column: str, default: Column) -> DataFrame:
    """Fills the null cells of an added column."""
    return df.withColumn(column, F.coalesce(F.col(column), default))


# Chance in percent of each payment method, tried in this order with a new draw each.
PAYMENT_CHANCES = [("credit_card", 40), ("debit_card", 70), ("paypal", 85), ("bank_transfer", 95)]
PAYMENT_DEFAULT = "cash"


def payment_method(key: Column) -> Column:
    """A payment method for rows from before the column existed, the same for a key on every run."""
    method = F.lit(PAYMENT_DEFAULT)
    for label, chance in reversed(PAYMENT_CHANCES):
        method = F.when(draw(f"payment-{label}", key, 100) < chance, label).otherwise(method)
    return method


def tag_schema_version(df: DataFrame, column: str) -> DataFrame:
    """Tells rows from before and after the column was added apart."""
    label = F.when(F.col(column).isNull(), "Old Data (before schema change)").otherwise("New Data (after schema change)")
    return df.withColumn("data_version", label)


def file_stats(df: DataFrame) -> DataFrame:
    """Rows per data file."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count("*").alias("record_count"))


def partition_stats(df: DataFrame, *columns: str) -> DataFrame:
    """Rows and data files per partition."""
    return df.groupBy(*columns).agg(
        F.count("*").alias("record_count"), F.count_distinct("_metadata.file_path").alias("file_count")
    )
