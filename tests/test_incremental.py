"""High-water marks, merges, additive summaries and their streaming forms."""

from pathlib import Path

from pyspark.sql import functions as F

from cartwright.operators import merge, models
from cartwright.operators.dedupe import EVENT_KEY
from cartwright.plans import reports, silver
from cartwright.plans.queries import event_model
from cartwright.session import read_if_written, scratch_path, shared_dir
from cartwright.streaming import incremental


def test_mark_is_strict(spark):
    target = spark.createDataFrame([(5,)], "_ingestion_time int")
    source = spark.createDataFrame([(4,), (5,), (6,)], "_ingestion_time int")
    assert [r[0] for r in merge.new_rows(source, target, lowest="-1").collect()] == [6]


def test_empty_target_takes_everything(spark):
    empty = spark.createDataFrame([], "_ingestion_time int")
    source = spark.createDataFrame([(4,), (5,)], "_ingestion_time int")
    assert merge.new_rows(source, empty, lowest="-1").count() == 2


def test_mark_reaches_the_scan(small):
    bronze = small.lake["bronze.events_raw"]
    plan = merge.new_rows(bronze, small.first_stg)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(_ingestion_time,ScalarSubquery" in plan


def rows(spark, path, *columns):
    return sorted(map(tuple, read_if_written(spark, path).select(*columns).collect()), key=str)


def merged(spark, *batches):
    """A table after merging (k, v, t, day) batches by k; the largest t wins."""
    path = scratch_path(spark, "merged")
    for values in batches:
        merge.merge_into(spark, path, spark.createDataFrame(values, "k string, v int, t int, day string"), ["k"], ["t"], "day")
    return path


def test_merge_updates_and_inserts(spark):
    path = merged(spark, [("a", 1, 1, "x"), ("b", 1, 1, "x")], [("b", 2, 2, "x"), ("c", 2, 2, "y")])
    assert rows(spark, path, "k", "v") == [("a", 1), ("b", 2), ("c", 2)]


def test_merge_picks_one_row_per_key(spark):
    path = merged(spark, [("a", 1, 1, "x")], [("a", 2, 2, "x"), ("a", 3, 3, "x"), ("a", 0, 0, "x")])
    assert rows(spark, path, "k", "v") == [("a", 3)]


def test_merge_keeps_the_null_day(spark):
    path = merged(spark, [("1", 1, 1, None), ("2", 1, 1, None), ("4", 1, 1, "x")], [("3", 1, 1, None), ("2", 2, 2, None)])
    assert rows(spark, path, "k", "v", "day") == [("1", 1, None), ("2", 2, None), ("3", 1, None), ("4", 1, "x")]
    path = merged(spark, [("1", 1, 1, None)], [("3", 1, 1, "x")])
    assert rows(spark, path, "k", "day") == [("1", None), ("3", "x")]


def test_merge_keeps_and_adds_columns(spark):
    path = scratch_path(spark, "evolving-merge")
    merge_rows = lambda values, schema: merge.merge_into(spark, path, spark.createDataFrame(values, schema), ["k"], ["t"], "day")
    merge_rows([("a", 1, "kept", "x"), ("b", 1, "too", "y")], "k string, t int, extra string, day string")
    merge_rows([("c", 1, "x")], "k string, t int, day string")
    assert rows(spark, path, "k", "extra") == [("a", "kept"), ("b", "too"), ("c", None)]
    merge_rows([("d", 1, 7, "y")], "k string, t int, later int, day string")
    assert rows(spark, path, "k", "extra", "later") == [("a", "kept", None), ("b", "too", None), ("c", None, None), ("d", None, 7)]


def test_empty_batch_changes_nothing(spark):
    path = merged(spark, [("a", 1, 1, "x")])
    merge.merge_into(spark, path, spark.createDataFrame([], "k string, v int, t int, day string"), ["k"], ["t"], "day")
    assert rows(spark, path, "k", "v") == [("a", 1)]


def test_merge_leaves_no_scratch(spark):
    before = set(Path(shared_dir(spark), "scratch").glob("merge-*"))
    merged(spark, [("a", 1, 1, "x")], [("a", 2, 2, "x")])
    assert set(Path(shared_dir(spark), "scratch").glob("merge-*")) == before


def test_incremental_equals_full_refresh(spark, small):
    path = scratch_path(spark, "refresh")
    for source in (small.delivery(0), small.bronze):
        models.as_incremental(spark, source, event_model, path, "event_id", "_ingestion_time", "event_date")
    full = event_model(small.bronze)
    got = read_if_written(spark, path).select(*full.columns)
    assert got.exceptAll(full).isEmpty() and full.exceptAll(got).isEmpty()


def batches(small):
    valid = silver.valid_events(small.bronze)
    return [valid.where(F.col("_batch_id") == b) for b in ("20240401_000000", "20240402_000000")]


def merged_table(spark, small, order):
    path = scratch_path(spark, "merge-test")
    for batch in order:
        merge.merge_into(spark, path, batch, EVENT_KEY, ["_ingestion_time"], "event_date")
    return spark.read.schema(small.bronze.schema).parquet(path)


def test_keyed_merge_ignores_order_and_replay(spark, small):
    first, second = batches(small)
    in_order = merged_table(spark, small, [first, second])
    assert in_order.count() == 980
    for order in ([second, first], [first, second, second, first]):
        other = merged_table(spark, small, order)
        assert in_order.exceptAll(other).isEmpty() and other.exceptAll(in_order).isEmpty()


def test_merge_rewrites_only_touched_days(spark, small):
    path = scratch_path(spark, "touched")
    first, second = batches(small)
    merge.merge_into(spark, path, first, EVENT_KEY, ["_ingestion_time"], "event_date")
    one_day = second.where(F.col("event_date") == second.agg(F.max("event_date")).first()[0])
    day_files = lambda: {
        (r[0], r[1]) for r in spark.read.parquet(path).select("event_date", "_metadata.file_path").distinct().collect()
    }
    before = day_files()
    merge.merge_into(spark, path, one_day, EVENT_KEY, ["_ingestion_time"], "event_date")
    assert len({day for day, _ in before ^ day_files()}) == 1


def test_streamed_events_equal_silver(spark, small):
    base = scratch_path(spark, "stream-test")
    landing, table = f"{base}/landing", f"{base}/table"
    for number in (1, 0):  # the redelivery arrives first
        small.delivery(number).write.mode("append").parquet(landing)
        incremental.run_event_merge(spark, landing, small.bronze.schema, table, f"{base}/checkpoint")
    streamed = silver.events_cleaned(spark.read.schema(small.bronze.schema).parquet(table))
    full = silver.events_cleaned(small.kept)
    assert streamed.exceptAll(full).isEmpty() and full.exceptAll(streamed).isEmpty()


def test_summaries_are_additive(small):
    for state, merged, read, table in (
        (reports.monthly_sales_state, reports.merge_monthly_sales, reports.read_monthly_sales, small.sales),
        (reports.segment_state, reports.merge_segments, reports.read_segments, small.customers),
    ):
        even = F.xxhash64(*table.columns) % 2 == 0
        halves = read(merged(state(table.where(even)), state(table.where(~even))))
        whole = read(state(table))
        assert whole.select(*halves.columns).exceptAll(halves).isEmpty()


def test_stages_add_up_to_events(small):
    stages = {r["stage"]: r["count"] for r in reports.funnel_stages(small.funnel).collect()}
    kinds = {r["event_type"]: r["event_count"] for r in reports.event_type_counts(small.silver).collect()}
    assert stages == {"Views": kinds["view"], "Carts": kinds["cart"], "Purchases": kinds["purchase"]}
