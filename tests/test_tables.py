"""Versions, schema evolution, sinks, quality tests and readers."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cartwright.__main__ import main
from cartwright.functions.sql import register_sql_functions
from cartwright.operators import models, quality, sinks, versions
from cartwright.plans import oracles
from cartwright.plans.medallion import JOB_TABLES, MODEL_TABLES, Medallion
from cartwright.plans.serving import serve
from cartwright.session import dataset_dir, scratch_path, shared_dir
from cartwright.sources import commerce, files
from cartwright.sources.schemas import RAW_EVENT, SERVING

DAY = [datetime(2024, 1, n) for n in range(1, 10)]


@pytest.fixture
def versioned(spark):
    """Two snapshots: three rows on the first day, two on the third."""
    rows = [(n, DAY[0] if n < 3 else DAY[2]) for n in range(5)]
    return spark.createDataFrame(rows, "x int, _ingestion_time timestamp")


def test_reads_by_version_and_time(versioned):
    assert versions.as_of_snapshot(versioned, 1).count() == 3 and versions.as_of_snapshot(versioned, 2).count() == 5
    for day, n in ((DAY[0], 3), (DAY[1], 3), (DAY[2], 5), (datetime(2023, 12, 31), 0)):
        assert versions.as_of_time(versioned, day).count() == n
    assert versions.as_of_snapshot(versioned, 9).isEmpty()


def test_snapshots_and_history(versioned):
    listed = [tuple(r) for r in versions.snapshots(versioned).select("snapshot_id", "parent_id", "added_records", "total_records").collect()]
    assert listed == [(2, 1, "2", "5"), (1, None, "3", "3")]
    assert versions.snapshots(versioned, 1).count() == 1
    flags = {r["snapshot_id"]: r["is_current_ancestor"] for r in versions.history(versioned, 1).collect()}
    assert flags == {1: True, 2: False}


def test_diff_counts_duplicates(spark):
    older = spark.createDataFrame([("a",), ("a",), ("b",)], "x string")
    current = spark.createDataFrame([("a",), ("c",), ("c",)], "x string")
    got = {tuple(r) for r in versions.diff_rows(older, current).collect()}
    assert got == {("a", "removed", 1), ("b", "removed", 1), ("c", "added", 2)}


def test_schema_operations(spark):
    df = spark.createDataFrame([(1, "x", 2)], "a int, b string, c int")
    wider = versions.add_column(df, "d", "string", "a note")
    assert wider.schema["d"].metadata == {"comment": "a note"}
    assert versions.add_column(wider, "d", "string") is wider
    shaped = versions.reshape(wider, rename={"a": "first"}, drop=["b"], cast={"c": "bigint"}, first=["c"])
    assert [(f.name, f.dataType.simpleString()) for f in shaped.schema] == [
        ("c", "bigint"),
        ("first", "int"),
        ("d", "string"),
    ]
    changes = {r["column_name"]: r["change"] for r in versions.schema_changes(spark, df.schema, shaped.schema).collect()}
    assert changes == {"a": "dropped", "b": "dropped", "c": "retyped", "first": "added", "d": "added"}


def test_catalog_column_is_added_once(spark):
    files.create_namespace(spark, "evolving")
    spark.sql("DROP TABLE IF EXISTS evolving.t")
    path = scratch_path(spark, "evolving")
    spark.range(2).write.parquet(path)
    files.external_table(spark, "evolving.t", path)
    assert versions.add_table_column(spark, "evolving.t", "channel", "string", "where it was sold")
    assert not versions.add_table_column(spark, "evolving.t", "channel", "string")
    assert spark.table("evolving.t").where("channel IS NULL").count() == 2
    assert versions.catalog_table_as_of(spark, "evolving.t").count() == 2
    spark.sql("DROP TABLE evolving.t")


def test_backfill_only_touches_nulls(spark):
    df = spark.createDataFrame([(n, None if n % 2 else "kept") for n in range(2000)], "id int, payment_method string")
    filled = versions.backfill(df, "payment_method", versions.payment_method(F.col("id")))
    counts = {r[0]: r[1] for r in filled.groupBy("payment_method").count().collect()}
    assert counts["kept"] == 1000 and None not in counts
    assert 340 < counts["credit_card"] < 460 and 360 < counts["debit_card"] < 480


@pytest.mark.parametrize("single_file", [False, True])
def test_csv_export_keeps_text(spark, folder, single_file):
    rows = [(1, 'say "hi", all'), (2, None), (3, " padded "), (4, "two\nlines"), (5, ""), (6, "back\\slash"), (7, "NULL"), (None, "x")]
    df = spark.createDataFrame(rows, "id int, text string")
    sinks.export_csv(df, f"{folder}/csv", single_file=single_file)
    back = sinks.read_exported_csv(spark, f"{folder}/csv", "id int, text string")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)
    assert len(list(Path(folder, "csv").glob("*.csv"))) == 1 or not single_file
    assert '"1","say ""hi"", all"' in "".join(f.read_text() for f in Path(folder, "csv").glob("*.csv"))


def test_observed_write_counts_rows(spark, folder):
    assert sinks.observed_write(spark.range(123), lambda df: df.write.parquet(f"{folder}/t")) == 123


def test_compaction_clusters_files_and_splits_a_hot_value(spark, folder):
    df = spark.range(4000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("c"), "id")
    df.sparkSession.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.compact_sorted(df, f"{folder}/t", "c")
    finally:
        df.sparkSession.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    back = spark.read.parquet(f"{folder}/t")
    hot_files = back.where("c = 'hot'").select("_metadata.file_path").distinct().count()
    assert back.count() == 4000 and hot_files > 1


def test_one_failing_table_does_not_stop_the_sync(spark, small, folder):
    broken = small.sales.withColumn("order_count", F.raise_error(F.lit("broken")).cast("bigint"))
    status = sinks.sync_all(
        spark, {"daily_sales": (broken, f"{folder}/a"), "funnel_analysis": (small.funnel, f"{folder}/b")}
    )
    got = {r["table_name"]: (r["ok"], r["target_rows"]) for r in status.collect()}
    assert got == {"daily_sales": (False, None), "funnel_analysis": (True, 90)}
    assert status.where("NOT ok").first()["error"]


def test_jdbc_options():
    options = sinks.jdbc_options("jdbc:x://host/db", "t", "some.Driver", user="u", password="p")
    assert options["batchsize"] == "100000" and options["isolationLevel"] == "NONE"
    assert options["truncate"] == "true" and options["dbtable"] == "t" and options["user"] == "u"


@pytest.mark.parametrize("table", list(SERVING))
def test_serving_types(small, table):
    served = serve(small.gold_tables()[table], table)
    assert [(f.name, f.dataType.simpleString()) for f in served.schema] == [
        (name, kind.replace(";", ",")) for name, kind in oracles._served_columns(table)
    ]
    assert served.where("_aggregated_at IS NULL").isEmpty()


def test_serving_copy_without_a_month_is_ranged(spark, folder):
    rows = [(f"s{n % 4}", n % 9, n) for n in range(4000)]
    columns = "customer_segment string, rfm_score int, user_id long"
    gold_table = spark.createDataFrame(rows, columns)
    others = {source: F.lit(None) for _, source, _ in SERVING["customer_rfm"] if source not in gold_table.columns}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_serving(gold_table.withColumns(others), "customer_rfm", f"{folder}/t")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    back = spark.read.parquet(f"{folder}/t")
    per_file = back.groupBy("_metadata.file_path").agg(F.count_distinct("customer_segment").alias("n"))
    assert back.count() == 4000 and per_file.count() > 4 and per_file.agg(F.max("n")).first()[0] <= 2


def test_quality_finds_failures(spark):
    tests = quality.TableTests(unique=["k"], not_null=["k", "v"], accepted={"v": ["a", "b"]})
    df = spark.createDataFrame([(1, "a"), (1, "c"), (2, None), (None, "b")], "k int, v string")
    assert quality.unique_failures(df, "t", "k").first()["failures"] == 1
    failures = {(r["column_name"], r["test"]): r["failures"] for r in quality.row_failures(df, "t", tests).collect()}
    assert failures == {("k", "not_null"): 1, ("v", "not_null"): 1, ("v", "accepted_values"): 1}


def test_quality_suite_passes(small):
    report = quality.report(small.model_tables)
    assert report.count() == 30 and report.where("NOT passed").isEmpty()


def test_text_time_is_cast_or_null(spark, folder):
    Path(folder, "in.csv").write_text(
        ",".join(f.name for f in RAW_EVENT) + "\n2019-10-01 00:00:00 UTC,view,1,2,a.b,x,1.5,7,s\nnot a time,view,1,2,,,,7,s\n"
    )
    inferred = files.read_csv_events(spark, f"{folder}/in.csv", None)
    assert [f.dataType.simpleString() for f in inferred.schema][1:4] == ["string", "int", "int"]
    typed = files.read_csv_events_as_text(spark, f"{folder}/in.csv").orderBy(F.col("event_time").desc()).collect()
    assert [r["event_time"] for r in typed] == [datetime(2019, 10, 1), None]
    bronze = files.ingest_csv(spark, f"{folder}/in.csv", "b1").where("event_time IS NOT NULL").first()
    assert bronze["_source_file"].endswith("in.csv") and bronze["_batch_id"] == "b1" and bronze["event_year"] == 2019


def test_rows_as_source(spark, folder):
    rows = [(datetime(2024, 1, 20, 12), "view", 99999, 100, "demo.category", "DemoBrand", 10.0, 99999, "demo_session")] * 10
    events = files.events_from_rows(spark, rows)
    assert events.first()["event_month"] == 1 and events.columns[:9] == RAW_EVENT.names
    sinks.write_partitioned(events, f"{folder}/t", "event_date", max_records=4)
    sinks.append(events, f"{folder}/t", "event_date")
    back = spark.read.parquet(f"{folder}/t")
    assert back.count() == 20 and versions.file_stats(back).agg(F.count("*")).first()[0] == 4
    assert {r["record_count"] for r in versions.file_stats(back).collect()} == {2, 4, 10}


def test_partition_columns_need_an_event_time(spark):
    df = spark.range(1)
    assert commerce.with_partition_columns(df) is df


def test_medallion_builds_every_table(spark, small):
    lake = Medallion(spark, scratch_path(spark, "lake"), lambda: small.bronze, F.to_date(F.lit("2024-04-15")))
    before = {p.name for p in Path(shared_dir(spark), "scratch").glob("*")}
    lake.build(JOB_TABLES)
    lake.build(MODEL_TABLES)
    assert lake["gold.funnel_analysis"].count() == lake["gold.fct_funnel"].count() == 90
    assert "_aggregated_at" in lake["gold.daily_sales"].columns
    left = [p.name for p in Path(shared_dir(spark), "scratch").glob("*") if p.name.startswith(("ntile", "rank", "position"))]
    assert len(left) == len(set(left) & before), "a build leaves nothing in the scratch folder"


def test_shared_folder_follows_the_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert shared_dir(spark).startswith(root.rstrip("/"))
    assert dataset_dir(spark, "a") != dataset_dir(spark, "b")


def test_samples_and_schema(spark, small):
    assert files.sample(small.sales, 5, "event_date", "order_count").count() == 5
    assert [tuple(r) for r in files.describe_schema(spark.range(1)).collect()] == [(0, "id", "bigint")]


def test_command_line(spark, small, folder):
    text_time = F.concat(F.col("event_time").cast("string"), F.lit(" UTC"))
    raw = small.bronze.select(*commerce.RAW_COLUMNS).withColumn("event_time", text_time)
    raw.write.option("header", True).csv(f"{folder}/raw")
    lake = ["--lake", f"{folder}/lake"]
    assert main(["build", *lake, "--source", f"{folder}/raw/*.csv"]) == 0
    assert spark.read.parquet(f"{folder}/lake/gold/funnel_analysis").count() == 90
    assert main(["serve", *lake, "--target", f"{folder}/serving"]) == 0
    assert spark.read.parquet(f"{folder}/serving/customer_rfm").count() == 15
    assert main(["export", *lake, "--target", f"{folder}/csv", "--table", "daily_sales"]) == 0
    assert spark.read.option("header", True).csv(f"{folder}/csv/daily_sales").count() == 178
    assert main(["check", *lake]) == 0


def test_view_and_table_models(spark, folder):
    files.create_namespace(spark, "models")
    models.as_table(spark.range(3), "models.kept", f"{folder}/t")
    models.as_view(spark, "SELECT * FROM models.kept WHERE id > 0", "models.few")
    assert spark.table("models.few").count() == 2
    models.as_table(spark.range(4), "models.kept", f"{folder}/t")
    assert spark.table("models.few").count() == 3 and spark.table("models.kept").count() == 4
    spark.sql("DROP VIEW models.few")
    spark.sql("DROP TABLE models.kept")


def test_a_shared_folder_is_required(spark):
    class Bare:
        conf = {}
        sparkContext = type("Context", (), {"getCheckpointDir": staticmethod(lambda: None), "applicationId": "x"})

    with pytest.raises(RuntimeError):
        shared_dir(Bare())


def test_sql_functions(spark):
    register_sql_functions(spark)
    row = spark.sql(
        """SELECT conversion_rate(1, 3), conversion_rate(1, 0), conversion_rate_or_null(1, 0), cents_to_dollars(1234),
        rfm_segment(5, 5, 5), rfm_segment(1, 3, 1), surrogate_key(array('a', NULL)) = md5('a|_NULL_'),
        in_date_range(date'2024-01-31', date'2024-01-01', date'2024-01-31')"""
    ).first()
    assert tuple(row) == (33.3333, 0.0, None, 12.34, "Champions", "Others", True, True)
