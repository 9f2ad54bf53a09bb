"""Every registered query: a name and a function of the session and the table folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.functions import events as ev
from cartwright.functions import money
from cartwright.functions import segments as sg
from cartwright.functions.sql import register_sql_functions
from cartwright.operators import buckets, curves, dedupe, distinct_counts, gate, ledger, merge, models, quality, ranking, rollups, sinks, tiles, versions
from cartwright.plans import gold, reports, serving, silver
from cartwright.plans.medallion import Medallion
from cartwright.session import dataset_dir, materialise, read_if_written, scratch_path
from cartwright.sources import commerce, files
from cartwright.sources.schemas import AUDIT
from cartwright.streaming import dedupe as stream_dedupe
from cartwright.streaming import incremental

# Parameters of the registered queries, shared with their SQL.
AS_OF = "2024-04-15"
RANGE_FIRST, RANGE_LAST = "2024-01-15", "2024-02-14"
TREND_FIRST, TREND_BEFORE = "2024-02-01", "2024-04-01"
CATEGORIES = ["economy", "small", "uncategorized"]
MIN_VIEWS, MAX_PURCHASE_RATE = 20, 30.0
COMMITS = [datetime(2024, 4, day, tzinfo=timezone.utc) for day in (1, 2, 3)]
THIRD_BATCH = "20240403_000000"
LONG_DELAY, SHORT_DELAY, FIRST_LANDED = "4000 days", "10 days", "2024-03-01"
FORGOTTEN_CATEGORY, FORGOTTEN_USERS = "economy", 5
BUCKETS = 8
PAYMENT_METHODS = ["credit_card", "paypal", "bank_transfer"]

Query = Callable[[SparkSession, str], DataFrame]

_lakes: dict[tuple[str, str], "Inputs"] = {}


class Inputs:
    """The tables one data folder offers to the queries."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.lake = Medallion(
            spark, f"{dataset_dir(spark, sf_dir)}/lake", lambda: self.bronze, F.to_date(F.lit(AS_OF))
        )

    def table(self, name: str) -> DataFrame:
        """A written table without its audit column."""
        return self.lake[name].drop("_transform_time", "_created_at", "_aggregated_at")

    @cached_property
    def bronze(self) -> DataFrame:
        return commerce.bronze_events(self.spark, self.sf_dir)

    @property
    def silver(self) -> DataFrame:
        return self.table("silver.events_cleaned")

    @property
    def stg(self) -> DataFrame:
        return self.table("silver.stg_events")

    @property
    def sales(self) -> DataFrame:
        return self.table("gold.daily_sales")

    @property
    def funnel(self) -> DataFrame:
        return self.table("gold.funnel_analysis")

    @property
    def customers(self) -> DataFrame:
        return self.table("gold.customer_rfm")

    @property
    def performance(self) -> DataFrame:
        return self.table("gold.product_performance")

    @property
    def traffic(self) -> DataFrame:
        return self.table("gold.hourly_traffic")

    @property
    def kept(self) -> DataFrame:
        """The deduplicated events, as a written table."""
        return self.lake["silver.events_deduplicated"]

    @cached_property
    def first_stg(self) -> DataFrame:
        """The event model after the first delivery, as a written table."""
        return materialise(event_model(self.delivery(0)), "first-stg")

    def delivery(self, number: int) -> DataFrame:
        return self.bronze.where(F.col("_batch_id") == commerce.DELIVERIES[number][1])

    def paid_purchases(self) -> DataFrame:
        """Redelivered purchases in a third batch, with the evolved column."""
        methods = F.array(*map(F.lit, PAYMENT_METHODS))
        return self.delivery(1).where(silver.of_type("purchase")).withColumns(
            {
                "_ingestion_time": F.lit(COMMITS[2]),
                "_batch_id": F.lit(THIRD_BATCH),
                "payment_method": F.get(methods, (F.col("user_id") % len(PAYMENT_METHODS)).cast("int")),
            }
        )

    @cached_property
    def versions(self) -> DataFrame:
        """First delivery, redelivery, and rows with an added column: three snapshots of one table."""
        return self.bronze.unionByName(self.paid_purchases(), allowMissingColumns=True)

    @cached_property
    def model_tables(self) -> dict[str, DataFrame]:
        names = {
            "stg_events": "silver.stg_events",
            "stg_products": "silver.stg_products",
            "stg_users": "silver.stg_users",
            "fct_daily_sales": "gold.fct_daily_sales",
            "fct_funnel": "gold.fct_funnel",
            "dim_customer_rfm": "gold.dim_customer_rfm",
        }
        return {short: self.table(name) for short, name in names.items()}

    def gold_tables(self) -> dict[str, DataFrame]:
        return {
            "daily_sales": self.sales,
            "funnel_analysis": self.funnel,
            "customer_rfm": self.customers,
            "product_performance": self.performance,
        }

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """The inputs of a data folder; tables written earlier in this application are read again."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _lakes:
        _lakes[key] = Inputs(spark, sf_dir)
    return _lakes[key]


def event_model(bronze: DataFrame) -> DataFrame:
    return silver.stg_events(silver.deduplicated(bronze))


def portable(df: DataFrame) -> DataFrame:
    """Column types every SQL engine has: all integers as long, decimals as double."""
    casts = {}
    for field in df.schema:
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            casts[field.name] = F.col(field.name).cast("long")
        elif isinstance(field.dataType, T.DecimalType):
            casts[field.name] = F.col(field.name).cast("double")
    return df.withColumns(casts) if casts else df


# --- sources and sinks -----------------------------------------------------------------------------


def _written_csv(i: Inputs) -> str:
    """The raw events as CSV files, with the time written as `... UTC` text."""
    path = i.scratch("csv")
    text = F.concat(F.col("event_time").cast("string"), F.lit(" UTC"))
    raw = i.bronze.select(*commerce.RAW_COLUMNS).withColumn("event_time", text)
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    raw.write.options(header=True, **blanks).csv(path)
    return path


def _raw(i: Inputs) -> DataFrame:
    return i.bronze.select(*commerce.RAW_COLUMNS)


def bronze_lineage(i: Inputs) -> DataFrame:
    ingested_at = F.lit(commerce.DELIVERIES[0][0]).cast("timestamp")
    rows = files.ingest_csv(i.spark, f"{_written_csv(i)}/*.csv", commerce.DELIVERIES[0][1], ingested_at)
    is_csv = F.col("_source_file").endswith(".csv")
    return rows.select("event_time", "event_type", "user_id", "_ingestion_time", "_batch_id", is_csv.alias("from_csv"))


def sink_partitioned_roundtrip(i: Inputs) -> DataFrame:
    path = i.scratch("partitioned")
    sinks.write_partitioned(i.silver, path, "event_year", "event_month")
    return i.spark.read.parquet(path).select(*silver.CLEAN_COLUMNS)


def sink_append(i: Inputs) -> DataFrame:
    path = i.scratch("append")
    for number in range(len(commerce.DELIVERIES)):
        sinks.append(i.delivery(number), path, "event_year", "event_month")
    return i.spark.read.parquet(path).select(*commerce.RAW_COLUMNS, "_batch_id")


def compact_sorted(i: Inputs) -> DataFrame:
    path = i.scratch("compacted")
    sinks.compact_sorted(i.sales, path, "category_level1", "event_date")
    return i.spark.read.parquet(path)


def _clustered(i: Inputs) -> str:
    """Where the clean events lie clustered by time, product and user."""
    path = i.scratch("curve")
    listed = i.silver.select("event_time", "event_type", "product_id", "user_id", "user_session")
    curves.write_clustered(listed, path, "event_time", "product_id", "user_id")
    return path


def curve_roundtrip(i: Inputs) -> DataFrame:
    return i.spark.read.parquet(_clustered(i))


def curve_file_ranges(i: Inputs) -> DataFrame:
    """What the ranges of all files say of the table."""
    ranges = curves.file_ranges(i.spark, _clustered(i), "event_time", "product_id", "user_id")
    ends = [f(f"{n}_{c}").alias(f"{n}_{c}") for c in ("event_time", "product_id", "user_id") for n, f in (("least", F.min), ("greatest", F.max))]
    return ranges.agg(F.sum("row_count").alias("row_count"), *ends)


def _serving_targets(i: Inputs) -> dict[str, tuple[DataFrame, str]]:
    return {name: (df, i.scratch(f"serve-{name}")) for name, df in i.gold_tables().items()}


def sync_status(i: Inputs) -> DataFrame:
    return sinks.sync_all(i.spark, _serving_targets(i)).drop("error")


def row_count_reconcile(i: Inputs) -> DataFrame:
    targets = _serving_targets(i)
    sinks.sync_all(i.spark, targets)
    served = {name: i.spark.read.parquet(path) for name, (_, path) in targets.items()}
    return sinks.reconcile(i.gold_tables(), served)


EXPORTED = ["event_date", "category_level1", "category_level2", "order_count", "unique_customers", "total_revenue"]
TEXT_COLUMNS = ["user_session", "_batch_id", "brand", "category_code"]
EXPORT_SCHEMA = (
    "event_date date, category_level1 string, category_level2 string, order_count long, "
    "unique_customers long, total_revenue double"
)


def export_csv_projected(i: Inputs) -> DataFrame:
    path = i.scratch("export")
    sinks.export_csv(i.sales, path, EXPORTED)
    return sinks.read_exported_csv(i.spark, path, EXPORT_SCHEMA)


def export_csv_single(i: Inputs) -> DataFrame:
    path = i.scratch("single")
    sinks.export_csv(i.sales, path, EXPORTED, single_file=True)
    return sinks.read_exported_csv(i.spark, path, EXPORT_SCHEMA)


def export_csv_text(i: Inputs) -> DataFrame:
    """Raw text with blanks, empty values and nulls, written and read back."""
    path = i.scratch("text")
    sinks.export_csv(i.bronze, path, TEXT_COLUMNS)
    return sinks.read_exported_csv(i.spark, path, i.bronze.select(*TEXT_COLUMNS).schema)


def sink_truncate_reload(i: Inputs) -> DataFrame:
    path = i.scratch("reload")
    sinks.truncate_and_load(i.customers, path)
    sinks.truncate_and_load(i.customers, path)
    return i.spark.read.parquet(path).select(*i.customers.columns)


NAMESPACE = "shop"


def _catalog_table(i: Inputs, name: str, df: DataFrame, *partition_by: str) -> str:
    """Writes `df` as a table of the namespace; its name."""
    files.create_namespace(i.spark, NAMESPACE)
    full = f"{NAMESPACE}.{name}"
    i.spark.sql(f"DROP TABLE IF EXISTS {full}")
    files.write_table(df, full, i.scratch(name), *partition_by)
    return full


def scan_table(i: Inputs) -> DataFrame:
    name = _catalog_table(i, "events_cleaned", i.silver, "event_year", "event_month")
    return files.read_table(i.spark, name).select(*silver.CLEAN_COLUMNS)


def namespace_tables(i: Inputs) -> DataFrame:
    """The tables of the namespace after two were written."""
    names = [_catalog_table(i, name, df) for name, df in (("listed_sales", i.sales), ("listed_funnel", i.funnel))]
    listed = i.spark.sql(f"SHOW TABLES IN {NAMESPACE}").where(F.col("tableName").isin([n.split(".")[1] for n in names]))
    return listed.select("namespace", F.col("tableName").alias("table_name"))


def model_as_table(i: Inputs) -> DataFrame:
    """A model kept as a table, built twice."""
    name, path = f"{NAMESPACE}.fct_funnel", i.scratch("fct-funnel")
    files.create_namespace(i.spark, NAMESPACE)
    i.spark.sql(f"DROP TABLE IF EXISTS {name}")
    for _ in range(2):
        models.as_table(i.table("gold.fct_funnel"), name, path)
    return files.read_table(i.spark, name)


def model_as_view(i: Inputs) -> DataFrame:
    """A model kept as a catalog view over a table."""
    table = _catalog_table(i, "daily_sales", i.sales)
    query = f"SELECT event_date, category_level1, sum(order_count) AS order_count FROM {table} GROUP BY event_date, category_level1"
    models.as_view(i.spark, query, f"{NAMESPACE}.sales_by_category")
    return files.read_table(i.spark, f"{NAMESPACE}.sales_by_category")


def data_files(i: Inputs) -> DataFrame:
    """The rows of each data file of a table, summed up by its month."""
    listed = versions.file_stats(_clustered_events(i))
    year, month = (F.regexp_extract("file_path", f"{c}=([0-9]+)/", 1).cast("int") for c in ("event_year", "event_month"))
    by_month = listed.groupBy(year.alias("event_year"), month.alias("event_month"))
    return by_month.agg(F.sum("record_count").alias("record_count"), F.count("*").alias("file_count"))


def event_sample(i: Inputs) -> DataFrame:
    """The first raw events."""
    return files.sample(files.read_parquet(i.spark, f"{i.sf_dir}/events.parquet").orderBy("event_id"))


def sorted_table(i: Inputs) -> DataFrame:
    """The funnel with its place in a global sort."""
    path = i.scratch("sorted")
    i.funnel.orderBy("event_date").write.parquet(path)
    place = F.struct("_metadata.file_path", "_metadata.row_index")
    rows = i.spark.read.parquet(path).withColumn("place", place)
    return rows.select("event_date", F.row_number().over(Window.orderBy("place")).alias("position"))


def external_table_read(i: Inputs) -> DataFrame:
    i.performance
    name = "external_product_performance"
    i.spark.sql(f"DROP TABLE IF EXISTS {name}")
    table = files.external_table(i.spark, name, i.lake.path("gold.product_performance"))
    return table.drop(AUDIT)


def _served_copy(table: str) -> Callable[[Inputs], DataFrame]:
    """All rows of a written serving copy, without the audit time."""

    def query(i: Inputs) -> DataFrame:
        path = i.scratch(f"layout-{table}")
        sinks.write_serving(i.gold_tables()[table], table, path)
        return i.spark.read.parquet(path).drop(AUDIT)

    return query


def serving_types(i: Inputs) -> DataFrame:
    """Table, place, name, type and number of values of every serving column."""
    parts = []
    for table, gold_table in i.gold_tables().items():
        served = serving.serve(gold_table, table)
        columns = [
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(n).cast("long").alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.count(field.name).alias("value_count"),
            )
            for n, field in enumerate(served.schema)
        ]
        parts.append(served.agg(F.array(*columns).alias("columns")).select(F.inline("columns")))
    return reduce(DataFrame.unionByName, parts)


# --- versions --------------------------------------------------------------------------------------


def snapshot_diff(i: Inputs) -> DataFrame:
    older, current = (versions.as_of_snapshot(i.versions, n) for n in (1, 2))
    changes = versions.diff_rows(older.drop("_source_file"), current.drop("_source_file"))
    return changes.select(*commerce.RAW_COLUMNS, "_batch_id", "change", "copies")


def schema_version_tag(i: Inputs) -> DataFrame:
    tagged = versions.tag_schema_version(i.versions, "payment_method")
    order = [
        F.col("payment_method").isNotNull(),
        F.col("event_time").desc(),
        F.col("_ingestion_time").desc(),
        F.col("event_type"),
        F.col("user_id"),
    ]
    return tagged.orderBy(*order).limit(10).select("event_type", "user_id", "price", "payment_method", "data_version")


def _clustered_events(i: Inputs) -> DataFrame:
    path = i.scratch("clustered")
    sinks.write_clustered(i.silver, path, ["event_year", "event_month"], ["event_type"])
    return i.spark.read.parquet(path)


def partition_stats(i: Inputs) -> DataFrame:
    return versions.partition_stats(_clustered_events(i), "event_year", "event_month")


def evolve_add_column(i: Inputs) -> DataFrame:
    evolved = versions.add_column(i.sales, "sales_channel", "string", "Sales channel: online, retail, mobile")
    evolved = versions.add_column(evolved, "sales_channel", "string")
    return evolved.select("event_date", "category_level1", "category_level2", "total_revenue", "sales_channel")


def evolve_rename_drop_cast(i: Inputs) -> DataFrame:
    return versions.reshape(
        i.sales,
        rename={"order_count": "orders"},
        drop=["min_order_value", "max_order_value", "avg_order_value"],
        cast={"sale_week": "bigint"},
        first=["sale_year", "sale_month"],
    )


def backfill_default(i: Inputs) -> DataFrame:
    filled = versions.backfill(
        i.versions, "payment_method", versions.payment_method(F.concat_ws("/", "user_session", "event_time"))
    )
    return filled.groupBy("event_type", "payment_method").agg(F.count("*").alias("event_count"))


# --- incremental and streaming ---------------------------------------------------------------------


def incremental_new_rows(i: Inputs) -> DataFrame:
    return merge.new_rows(i.bronze, i.first_stg).select(*commerce.RAW_COLUMNS, "_ingestion_time")


def merge_upsert_events(i: Inputs) -> DataFrame:
    """The first load as a table, and what came later merged into it."""
    path = i.scratch("merged")
    for batch in (i.first_stg, event_model(merge.new_rows(i.bronze, i.first_stg))):
        merge.merge_into(i.spark, path, batch, ["event_id"], ["_ingestion_time"], "event_date")
    return read_if_written(i.spark, path).drop("_source_file")


def incremental_refresh(i: Inputs) -> DataFrame:
    """The event model after a first load and one incremental run."""
    path = i.scratch("incremental")
    for source in (i.delivery(0), i.bronze):
        models.as_incremental(i.spark, source, event_model, path, "event_id", "_ingestion_time", "event_date")
    return read_if_written(i.spark, path).drop("_source_file")


def sql_functions(i: Inputs) -> DataFrame:
    register_sql_functions(i.spark)
    i.performance.createOrReplaceTempView("product_performance_view")
    return i.spark.sql(
        """SELECT product_id, category_level1, category_level2, brand,
        conversion_rate(carts, views) AS rate, conversion_rate_or_null(carts, views) AS rate_or_null,
        cents_to_dollars(purchases) AS dollars, surrogate_key(array(string(product_id), category_level1, brand)) AS key
        FROM product_performance_view"""
    )


def stream_merge_events(i: Inputs) -> DataFrame:
    base = i.scratch("stream-events")
    landing, table = f"{base}/landing", f"{base}/table"
    for number in range(len(commerce.DELIVERIES)):
        i.delivery(number).write.mode("append").parquet(landing)
        incremental.run_event_merge(i.spark, landing, i.bronze.schema, table, f"{base}/checkpoint")
    return read_if_written(i.spark, table).drop("_source_file")


def stream_monthly_sales(i: Inputs) -> DataFrame:
    base = i.scratch("stream-sales")
    landing, table = f"{base}/landing", f"{base}/table"
    sales = i.sales
    first = F.dayofmonth("event_date") <= 15
    for arriving in (first, ~first):
        sales.where(arriving).write.mode("append").parquet(landing)
        incremental.run_monthly_sales(i.spark, landing, sales.schema, table, f"{base}/checkpoint")
    return incremental.read_monthly_summary(i.spark, table)


def mv_monthly_sales(i: Inputs) -> DataFrame:
    """The summary of two halves, merged."""
    first = F.dayofmonth("event_date") <= 15
    state = reports.merge_monthly_sales(
        reports.monthly_sales_state(i.sales.where(first)), reports.monthly_sales_state(i.sales.where(~first))
    )
    return reports.read_monthly_sales(state)


def mv_segment_summary(i: Inputs) -> DataFrame:
    first = F.col("rfm_score") <= 9
    state = reports.merge_segments(
        reports.segment_state(i.customers.where(first)), reports.segment_state(i.customers.where(~first))
    )
    return reports.read_segments(state)


# --- state that survives late rows, updates and deletes ---------------------------------------------


def _landing(i: Inputs, label: str) -> tuple[str, str, str]:
    base = i.scratch(label)
    return f"{base}/landing", f"{base}/table", f"{base}/checkpoint"


def stream_dedupe_events(i: Inputs) -> DataFrame:
    """The first delivery of each valid event; the stream is started anew for the redelivery."""
    landing, table, checkpoint = _landing(i, "stream-dedupe")
    for number in range(len(commerce.DELIVERIES)):
        i.delivery(number).write.mode("append").parquet(landing)
        stream_dedupe.run_event_dedupe(i.spark, landing, i.bronze.schema, table, checkpoint, LONG_DELAY)
    return i.spark.read.parquet(table).select(*dedupe.EVENT_KEY, "_batch_id")


def stream_late_events(i: Inputs) -> DataFrame:
    """Events that were older than the watermark when they landed: the older ones land after the newer ones."""
    landing, table, checkpoint = _landing(i, "stream-late")
    newer = (F.col("event_time") >= F.lit(FIRST_LANDED).cast("timestamp")) & (F.col("_batch_id") == commerce.DELIVERIES[0][1])
    for landed in (i.bronze.where(newer), i.bronze.where(~newer)):
        landed.write.mode("append").parquet(landing)
        stream_dedupe.run_event_dedupe(i.spark, landing, i.bronze.schema, table, checkpoint, SHORT_DELAY)
    return stream_dedupe.late_events(i.spark.read.schema(i.bronze.schema).parquet(landing), i.spark.read.parquet(table))


def merge_bucketed_events(i: Inputs) -> DataFrame:
    """The first load as a bucketed table, and what came later merged into its buckets."""
    files.create_namespace(i.spark, NAMESPACE)
    name = f"{NAMESPACE}.bucketed_events"
    i.spark.sql(f"DROP TABLE IF EXISTS {name}")
    buckets.create_bucketed(i.first_stg, name, i.scratch("bucketed"), "event_id", "event_date", BUCKETS)
    later = event_model(merge.new_rows(i.bronze, i.first_stg))
    buckets.merge_bucketed(i.spark, name, later, "event_id", "_ingestion_time", "event_date")
    return i.spark.table(name).drop("_source_file")


def incremental_any_order(i: Inputs) -> DataFrame:
    """The event model when the second delivery is loaded before the first, which then comes twice."""
    path, listed = i.scratch("any-order"), i.scratch("any-order-ledger")
    for source in (i.delivery(1), i.bronze, i.bronze):
        ledger.load_new_batches(i.spark, source, event_model, path, listed, "event_id", "_ingestion_time", "event_date")
    return read_if_written(i.spark, path).drop("_source_file")


def monthly_customers(i: Inputs) -> DataFrame:
    """Customers by month and category, by month, and of all time, from the merged id sets of two halves of each month."""
    bought = i.silver.where(silver.of_type("purchase"))
    keys = {"sale_year": F.col("event_year"), "sale_month": F.col("event_month"), "category_level1": F.col("category_level1")}
    first = F.dayofmonth("event_date") <= 15
    halves = [distinct_counts.id_sets(bought.where(half), keys, "user_id") for half in (first, ~first)]
    sets = materialise(distinct_counts.merge_sets(*halves), "customer-sets")
    levels = [distinct_counts.distinct_ids(sets, *some, name="customers") for some in (list(keys), ["sale_year", "sale_month"], [])]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), levels)


def _first_sales(i: Inputs) -> DataFrame:
    return gold.daily_sales(silver.events_cleaned(silver.deduplicated(i.delivery(0))))


MONTHLY_SUMMARY = rollups.Summary(
    ("month", "category_level1"), ("order_count", "unique_customers", "revenue_cents"), ("order_count", "revenue_cents")
)
SEGMENT_SUMMARY = rollups.Summary(
    ("customer_segment",), ("monetary_cents", "recency", "frequency"), ("recency", "monetary_cents")
)


def _maintained(i: Inputs, label: str, summary: rollups.Summary, older: DataFrame, current: DataFrame, gone: DataFrame) -> DataFrame:
    """A summary after a first load, the changes up to the current rows, and deletes, which are applied twice."""
    path = i.scratch(label)
    batches = [rollups.inserted(older), rollups.signed_changes(older, current), rollups.deleted(gone)]
    for number, changes in enumerate([*batches, batches[-1]], 1):
        rollups.apply_changes(i.spark, path, summary, changes, min(number, len(batches)))
    return rollups.read_summary(i.spark, path, summary)


def mv_monthly_sales_changed(i: Inputs) -> DataFrame:
    """The monthly summary after the redelivery has changed prices, and without a category that was deleted."""

    def rows(sales: DataFrame) -> DataFrame:
        cents = money.to_cents(F.col("total_revenue")).alias("revenue_cents")
        month = F.date_format("event_date", "yyyy-MM").alias("month")
        return sales.select(month, "event_date", "category_level1", "category_level2", "order_count", "unique_customers", cents)

    older, current = materialise(rows(_first_sales(i)), "first-sales"), rows(i.sales)
    gone = current.where(F.col("category_level1") == FORGOTTEN_CATEGORY)
    return _maintained(i, "changed-sales", MONTHLY_SUMMARY, older, current, gone)


def mv_segment_summary_changed(i: Inputs) -> DataFrame:
    """The segment summary after customers have moved between segments and some have asked to be forgotten."""

    def rows(customers: DataFrame) -> DataFrame:
        cents = money.to_cents(F.col("monetary")).alias("monetary_cents")
        return customers.select("user_id", "customer_segment", "recency", "frequency", cents)

    first = gold.customer_rfm(silver.events_cleaned(silver.deduplicated(i.delivery(0))))
    older, current = materialise(rows(first), "first-customers"), rows(i.customers)
    gone = current.where(F.col("user_id") % FORGOTTEN_USERS == 0)
    return _maintained(i, "changed-segments", SEGMENT_SUMMARY, older, current, gone)


RFM_TILING = tiles.Tiling(("last_day", "frequency", "monetary_cents"), "user_id", gold.SCORE_TILES)


def rfm_scores_maintained(i: Inputs) -> DataFrame:
    """Scores from kept counts after a first load, the redelivery, and deletes, which are applied twice."""

    def rows(customers: DataFrame) -> DataFrame:
        day, cents = F.unix_date("last_purchase_date"), money.to_cents(F.col("monetary"))
        return customers.select("user_id", day.alias("last_day"), "frequency", cents.alias("monetary_cents"))

    first = gold.rfm_base(silver.events_cleaned(silver.deduplicated(i.delivery(0))))
    older, current = materialise(rows(first), "first-customers"), materialise(rows(i.customers), "customers-now")
    forgotten = F.col("user_id") % FORGOTTEN_USERS == 0
    path = i.scratch("rfm-tiles")
    tiles.apply_batch(i.spark, path, RFM_TILING, rollups.inserted(older), 1)
    tiles.apply_batch(i.spark, path, RFM_TILING, rollups.signed_changes(older, current), 2)
    for _ in range(2):
        tiles.apply_batch(i.spark, path, RFM_TILING, rollups.deleted(current.where(forgotten)), 3)
    names = {"last_day": "r_score", "frequency": "f_score", "monetary_cents": "m_score"}
    return tiles.add_kept_tiles(current.where(~forgotten), path, RFM_TILING, names).select("user_id", *names.values())


#: The third snapshot was made after a roll-back to the first, so the second is on an abandoned branch.
BRANCH = {3: 1}


def rollback_branch_read(i: Inputs) -> DataFrame:
    """What readers see after the roll-back and the append that followed it."""
    return versions.read_branch(i.versions, versions.commit_log(i.versions, BRANCH), 3).drop("_source_file")


def sorted_positions(i: Inputs) -> DataFrame:
    """The clean events with their place in the order of time; no task sees all of them."""
    listed = i.silver.select("event_time", "event_type", "product_id", "user_id", "user_session")
    return ranking.add_positions(listed, *listed.columns)


LINE_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("amount", T.LongType()),
    ]
)


def _lines(i: Inputs) -> str:
    """The events as CSV lines, some with a word for a number, too few or too many fields; the folder."""
    key = F.col("event_id")
    amount = F.when(key % 13 == 0, "n/a").otherwise(F.floor("value").cast("string"))
    line = F.when(key % 17 == 0, F.concat_ws(",", key, "user_id")).otherwise(F.concat_ws(",", key, "user_id", "event_type", amount))
    line = F.when(key % 19 == 0, F.concat(line, F.lit(",extra,extra"))).otherwise(line)
    path = i.scratch("lines")
    header = F.lit("event_id,user_id,event_type,amount")
    # Each file has the header of a CSV file.
    table = files.read_parquet(i.spark, f"{i.sf_dir}/events.parquet").select(line.alias("line"), (key % 4).alias("part"))
    headers = i.spark.range(4).select(header.alias("line"), F.col("id").alias("part"), F.lit(0).alias("place"))
    rows = headers.unionByName(table.withColumn("place", F.lit(1)))
    rows.repartition(4, "part").sortWithinPartitions("part", "place").select("part", "line").write.partitionBy("part").text(path)
    return f"{path}/part=*"


def scan_csv_checked(i: Inputs) -> DataFrame:
    """All lines of the files, read as rows or listed as rejected."""
    return files.read_csv_checked(i.spark, _lines(i), LINE_SCHEMA)


def scan_csv_quarantine(i: Inputs) -> DataFrame:
    """How many lines a load keeps and rejects, and how many rows the table and the quarantine have then."""
    table, quarantine = i.scratch("checked"), i.scratch("quarantine")
    counts = files.ingest_checked(i.spark, _lines(i), LINE_SCHEMA, table, quarantine)
    held = [i.spark.read.parquet(p).agg(F.count("*").alias(n)) for p, n in ((table, "table_rows"), (quarantine, "quarantine_rows"))]
    return counts.select("*", held[0].scalar().alias("table_rows"), held[1].scalar().alias("quarantine_rows"))


def evolve_columns_by_id(i: Inputs) -> DataFrame:
    """Two deliveries, the second under other names, with a wider number and a new column, read as one table."""
    old_ids = {"event_time": 1, "event_type": 2, "product_id": 3, "price": 4, "user_session": 5}
    new_ids = {"happened_at": 1, "kind": 2, "product_id": 3, "amount": 4, "user_session": 5, "batch": 6}
    paths = [i.scratch(f"by-id-{n}") for n in (0, 1)]
    old = i.delivery(0).withColumn("product_id", F.col("product_id").cast("int"))
    new = i.delivery(1).withColumnsRenamed({"event_time": "happened_at", "event_type": "kind", "price": "amount", "_batch_id": "batch"})
    for df, ids, path in ((old, old_ids, paths[0]), (new, new_ids, paths[1])):
        versions.with_field_ids(df, ids).write.parquet(path)
    return versions.read_by_id(i.spark, paths, new.select(*new_ids).schema, new_ids)


def _gate(i: Inputs) -> gate.Gate:
    """The event model of both deliveries behind a gate; the second holds keys of the first and other kinds are not accepted."""
    tests = gate.Gate(i.spark, i.scratch("gate"), "event_id", ["event_id", "user_id", "category_code"], {"event_type": EVENT_TYPES})
    for number in range(len(commerce.DELIVERIES)):
        tests.write(event_model(i.delivery(number)), number)
    return tests


EVENT_TYPES = ["view", "cart", "purchase", "remove_from_cart"]


def namespace_row_counts(i: Inputs) -> DataFrame:
    """The tables of the namespace that two models were written to, and their rows."""
    written = {"counted_sales": i.sales, "counted_funnel": i.funnel}
    names = [_catalog_table(i, name, df) for name, df in written.items()]
    listed = namespace_listing(i).where(F.col("table_name").isin(list(written)))
    counts = [i.spark.table(n).agg(F.lit(n.split(".")[1]).alias("table_name"), F.count("*").alias("row_count")) for n in names]
    return listed.join(reduce(DataFrame.unionByName, counts), "table_name").select("namespace", "table_name", "row_count")


def namespace_listing(i: Inputs) -> DataFrame:
    return i.spark.sql(f"SHOW TABLES IN {NAMESPACE}").select("namespace", F.col("tableName").alias("table_name"))


# --- the registry ----------------------------------------------------------------------------------


def _segment_query(rule: Callable) -> Callable[[Inputs], DataFrame]:
    def query(i: Inputs) -> DataFrame:
        scores = (F.col("r_score"), F.col("f_score"), F.col("m_score"))
        return i.customers.select("user_id", *scores, rule(*scores).alias("segment"))

    return query


def _cleaned(*columns: Callable) -> Callable[[Inputs], DataFrame]:
    return lambda i: i.bronze.select("event_time", "user_session", "_batch_id", *[make() for make in columns])


def _registry() -> dict[str, Callable[[Inputs], DataFrame]]:
    c = F.col
    category = lambda: ev.clean_category(c("category_code"))
    return {
        # scans, sources, sinks
        "scan_csv_events": lambda i: files.read_csv_events(i.spark, f"{_written_csv(i)}/*.csv"),
        "scan_csv_cast": lambda i: files.read_csv_events_as_text(i.spark, f"{_written_csv(i)}/*.csv"),
        "bronze_lineage": bronze_lineage,
        "bronze_partition_cols": lambda i: commerce.with_partition_columns(_raw(i)).select(
            "event_time", "user_session", "event_date", "event_year", "event_month"
        ),
        "scan_table": scan_table,
        "scan_parquet": lambda i: files.read_parquet(i.spark, f"{i.sf_dir}/events.parquet"),
        "sink_partitioned_roundtrip": sink_partitioned_roundtrip,
        "sink_append": sink_append,
        "compact_sorted": compact_sorted,
        "curve_roundtrip": curve_roundtrip,
        "curve_file_ranges": curve_file_ranges,
        "sync_status": sync_status,
        "export_csv_projected": export_csv_projected,
        "export_csv_single": export_csv_single,
        "export_csv_text": export_csv_text,
        "sink_truncate_reload": sink_truncate_reload,
        "row_count_reconcile": row_count_reconcile,
        "external_table_read": external_table_read,
        "serve_daily_sales": lambda i: serving.serve(i.sales, "daily_sales").drop(AUDIT),
        "serve_funnel": lambda i: serving.serve(i.funnel, "funnel_analysis").drop(AUDIT),
        "serve_rfm": lambda i: serving.serve(i.customers, "customer_rfm").drop(AUDIT),
        "serve_products": lambda i: serving.serve(i.performance, "product_performance").drop(AUDIT),
        "serve_layout_roundtrip": _served_copy("daily_sales"),
        "serve_layout_funnel": _served_copy("funnel_analysis"),
        "serve_layout_rfm": _served_copy("customer_rfm"),
        "serve_layout_products": _served_copy("product_performance"),
        "serving_types": serving_types,
        "namespace_tables": namespace_tables,
        "model_as_table": model_as_table,
        "model_as_view": model_as_view,
        "data_files": data_files,
        "event_sample": event_sample,
        "sorted_table": sorted_table,
        "sorted_positions": sorted_positions,
        "scan_csv_checked": scan_csv_checked,
        "scan_csv_quarantine": scan_csv_quarantine,
        "namespace_row_counts": namespace_row_counts,
        # cleaning and scalar rules
        "clean_brand": _cleaned(lambda: ev.clean_brand(c("brand")).alias("brand")),
        "clean_category": _cleaned(lambda: category().alias("category_code")),
        "clean_price": _cleaned(lambda: ev.clean_price(c("price")).alias("price")),
        "clean_price_rounded": _cleaned(lambda: ev.clean_price_rounded(c("price")).alias("price")),
        "category_levels": lambda i: i.bronze.select(
            "event_time", "user_session", *[level.alias(n) for n, level in ev.category_levels(category()).items()]
        ),
        "brand_normalized": _cleaned(lambda: ev.normalised_brand(c("brand")).alias("brand_normalized")),
        "price_tier": _cleaned(lambda: ev.price_tier(ev.clean_price(c("price"))).alias("price_tier")),
        "price_tier_raw": _cleaned(lambda: ev.price_tier_raw(c("price")).alias("price_tier")),
        "event_hour": _cleaned(lambda: F.hour("event_time").alias("event_hour")),
        "is_weekend": _cleaned(lambda: ev.is_weekend(c("event_time")).alias("is_weekend")),
        "is_weekend_compat": _cleaned(lambda: ev.is_weekend_compat(c("event_time")).alias("is_weekend")),
        "date_parts": lambda i: i.bronze.select(
            "event_time", "user_session", *[p.alias(n) for n, p in ev.date_parts(c("event_date"), "event").items()]
        ),
        "valid_events": lambda i: silver.valid_events(i.bronze).select(*commerce.RAW_COLUMNS, "_batch_id"),
        "dedupe_latest": lambda i: dedupe.latest_per_key(_with_ingestion(i), dedupe.EVENT_KEY, ["_ingestion_time"]),
        "dedupe_any": lambda i: dedupe.any_per_key(i.bronze, dedupe.EVENT_KEY).select(*dedupe.EVENT_KEY),
        "events_cleaned": lambda i: silver.events_cleaned(i.kept),
        "events_cleaned_compat": lambda i: silver.events_cleaned(i.kept, compat_weekend=True),
        "stg_events": lambda i: silver.stg_events(i.kept).drop("_source_file"),
        "surrogate_key": _cleaned(lambda: ev.surrogate_key(*[c(k) for k in dedupe.EVENT_KEY]).alias("event_id")),
        "date_range_filter": lambda i: _raw(i).where(ev.date_range(F.to_date("event_time"), RANGE_FIRST, RANGE_LAST)),
        "cents_to_dollars": lambda i: i.silver.select(
            "event_time", "user_session", money.cents_to_dollars(money.to_cents(c("price"))).alias("dollars")
        ),
        "conversion_rate_zero": lambda i: i.performance.select(
            *gold.PRODUCT_KEY, money.conversion_rate(c("carts"), c("views")).alias("rate")
        ),
        "conversion_rate_null": lambda i: i.performance.select(
            *gold.PRODUCT_KEY, money.percent(c("carts"), c("views")).alias("rate")
        ),
        "sql_functions": sql_functions,
        "session_bucket": lambda i: i.silver.select(
            "event_time", "user_id", ev.session_bucket(c("user_id"), c("event_time")).alias("session")
        ),
        "rfm_segments_8": _segment_query(sg.segment_8),
        "rfm_segments_12": _segment_query(sg.segment_12),
        "rfm_segments_6": _segment_query(sg.segment_6),
        "readable_quantity": lambda i: reports.readable_totals(i.sales),
        "backfill_default": backfill_default,
        "dashboard_filters": lambda i: reports.dashboard_filter(
            i.sales, reports.last_sale_date(i.sales), CATEGORIES
        ).select("event_date", "category_level1", "category_level2", "total_revenue"),
        # dimensions and gold tables
        "dim_products": lambda i: silver.dim_products(i.silver),
        "stg_products": lambda i: silver.stg_products(i.stg),
        "dim_users": lambda i: silver.dim_users(i.silver),
        "stg_users": lambda i: silver.stg_users(i.stg),
        "daily_sales": lambda i: gold.daily_sales(i.silver),
        "fct_daily_sales": lambda i: gold.fct_daily_sales(i.stg),
        "funnel_daily": lambda i: gold.funnel_daily(i.silver),
        "fct_funnel": lambda i: gold.fct_funnel(i.stg),
        "funnel_overall": lambda i: gold.funnel_overall(i.funnel),
        "rfm_base": lambda i: gold.rfm_base(i.silver),
        "rfm_base_asof": lambda i: gold.rfm_base_asof(i.stg, F.to_date(F.lit(AS_OF))),
        "customer_rfm": lambda i: gold.customer_rfm(i.silver),
        "dim_customer_rfm": lambda i: gold.dim_customer_rfm(i.stg, F.to_date(F.lit(AS_OF))),
        "hourly_traffic": lambda i: gold.hourly_traffic(i.silver),
        "hourly_traffic_compat": lambda i: gold.hourly_traffic(i.silver, compat_weekday=True),
        "product_performance": lambda i: gold.product_performance(i.silver),
        "product_ranks": lambda i: gold.product_ranks(gold.product_performance(i.silver)),
        # annotated views
        "stg_daily_sales": lambda i: reports.stg_daily_sales(i.sales),
        "stg_customer_rfm": lambda i: reports.stg_customer_rfm(i.customers),
        "stg_funnel_analysis": lambda i: reports.stg_funnel_analysis(i.funnel),
        "sales_quality_flags": lambda i: reports.sales_quality_flags(i.sales),
        # reports
        "segment_distribution": lambda i: reports.segment_distribution(i.customers),
        "revenue_by_month": lambda i: reports.revenue_by_month(i.sales),
        "revenue_last_30d": lambda i: reports.revenue_last_days(i.sales, reports.last_sale_date(i.sales)),
        "revenue_trend": lambda i: reports.revenue_trend(i.sales),
        "revenue_by_weekday": lambda i: reports.revenue_by_weekday(i.sales),
        "avg_conversion_rates": lambda i: reports.avg_conversion_rates(i.funnel),
        "funnel_by_month": lambda i: reports.funnel_by_month(i.funnel),
        "rfm_score_hist": lambda i: reports.rfm_score_hist(i.customers),
        "category_performance": lambda i: reports.category_performance(i.performance),
        "hourly_pattern": lambda i: reports.hourly_pattern(i.traffic),
        "mv_monthly_sales": mv_monthly_sales,
        "mv_segment_summary": mv_segment_summary,
        "revenue_by_category": lambda i: reports.revenue_by_category(i.sales),
        "customers_by_segment": lambda i: reports.customers_by_segment(i.customers),
        "kpi_summary": lambda i: reports.kpi_summary(i.sales, i.customers, i.funnel),
        "kpi_cards": lambda i: reports.kpi_cards(i.sales, i.customers, i.funnel),
        "table_profile": lambda i: reports.table_profile(i.sales),
        "monthly_stats": lambda i: reports.monthly_stats(i.sales),
        "monthly_trend_range": lambda i: reports.monthly_trend(i.sales, TREND_FIRST, TREND_BEFORE),
        "event_type_counts": lambda i: reports.event_type_counts(i.bronze),
        "event_profile": lambda i: reports.event_profile(i.bronze),
        "wow_growth": lambda i: reports.week_over_week(i.sales),
        "top_products": lambda i: reports.top_products(i.performance, 10),
        "top_products_20": lambda i: reports.top_products(i.performance, 20),
        "top_categories": lambda i: reports.top_categories(i.sales),
        "top_champions": lambda i: reports.top_champions(i.customers),
        "at_risk_customers": lambda i: reports.at_risk_customers(i.customers),
        "optimisation_candidates": lambda i: reports.optimisation_candidates(
            i.performance, MIN_VIEWS, MAX_PURCHASE_RATE
        ),
        "brand_performance": lambda i: reports.brand_performance(i.performance),
        "funnel_latest_30": lambda i: reports.funnel_latest(i.funnel),
        "funnel_stages": lambda i: reports.funnel_stages(i.funnel),
        # incremental
        "incremental_new_rows": incremental_new_rows,
        "merge_upsert_events": merge_upsert_events,
        "incremental_refresh": incremental_refresh,
        "stream_merge_events": stream_merge_events,
        "stream_monthly_sales": stream_monthly_sales,
        "stream_dedupe_events": stream_dedupe_events,
        "stream_late_events": stream_late_events,
        "merge_bucketed_events": merge_bucketed_events,
        "incremental_any_order": incremental_any_order,
        "monthly_customers": monthly_customers,
        "mv_monthly_sales_changed": mv_monthly_sales_changed,
        "mv_segment_summary_changed": mv_segment_summary_changed,
        "rfm_scores_maintained": rfm_scores_maintained,
        # versions and schema evolution
        "snapshot_list": lambda i: versions.snapshots(i.versions),
        "asof_version": lambda i: versions.as_of_snapshot(i.versions, 1).drop("_source_file"),
        "asof_timestamp": lambda i: versions.as_of_time(i.versions, COMMITS[1] + timedelta(hours=12)).drop("_source_file"),
        "snapshot_compare": lambda i: versions.compare_counts(versions.as_of_snapshot(i.versions, 1), i.versions),
        "snapshot_diff": snapshot_diff,
        "snapshot_history": lambda i: versions.history(i.versions),
        "snapshot_branches": lambda i: versions.branched_history(versions.commit_log(i.versions, BRANCH), 3),
        "rollback_branch_read": rollback_branch_read,
        "rollback_read": lambda i: versions.as_of_snapshot(i.versions, 2).drop("_source_file"),
        "evolve_add_column": evolve_add_column,
        "evolve_mixed_read": lambda i: i.versions.select(*commerce.RAW_COLUMNS, "_batch_id", "payment_method"),
        "schema_diff": lambda i: versions.schema_changes(
            i.spark, i.bronze.schema, i.versions.schema
        ),
        "evolve_columns_by_id": evolve_columns_by_id,
        "schema_change_counts": lambda i: versions.schema_change_counts(i.bronze, i.versions),
        "schema_version_tag": schema_version_tag,
        "evolve_rename_drop_cast": evolve_rename_drop_cast,
        "partition_stats": partition_stats,
        # data quality
        "dq_unique": lambda i: quality.check_unique(i.model_tables),
        "dq_not_null": lambda i: quality.check_rows(i.model_tables, "not_null"),
        "dq_accepted_values": lambda i: quality.check_rows(i.model_tables, "accepted_values"),
        "dq_at_write": lambda i: _gate(i).results(),
        "dq_accepted_rows": lambda i: _gate(i).read().drop("_source_file", "batch"),
        "dq_report": lambda i: quality.report(i.model_tables),
    }


def _with_ingestion(i: Inputs) -> DataFrame:
    return i.bronze.select(*commerce.RAW_COLUMNS, "_ingestion_time")


def _bind(build: Callable[[Inputs], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return portable(build(inputs(spark, sf_dir)))

    return query


def queries() -> dict[str, Query]:
    return {name: _bind(build) for name, build in _registry().items()}
