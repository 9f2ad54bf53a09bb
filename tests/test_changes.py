"""State that survives late rows, restarts, updates and deletes."""

import random
import time

import pytest
from pyspark.sql import functions as F

from cartwright.operators import buckets, distinct_counts, gate, ledger, ranking, rollups, versions
from cartwright.operators.dedupe import EVENT_KEY
from cartwright.plans import silver
from cartwright.session import read_if_written, scratch_path
from cartwright.sources import files
from cartwright.streaming import dedupe


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- streaming dedupe ---------------------------------------------------------------------------


@pytest.fixture
def stream(spark):
    base = scratch_path(spark, "dedupe-test")
    return f"{base}/landing", f"{base}/table", f"{base}/checkpoint"


def test_stopped_stream_equals_batch_dedupe(spark, small, stream):
    landing, table, checkpoint = stream
    small.bronze.repartition(6).write.parquet(landing)
    arguments = (spark, landing, small.bronze.schema, table, checkpoint, "4000 days", 1)
    query = dedupe.start_event_dedupe(*arguments)
    while not query.recentProgress and query.isActive:
        time.sleep(0.05)
    query.stop()
    before = spark.read.schema(small.bronze.schema).parquet(table).count()
    dedupe.run_event_dedupe(*arguments)
    got = spark.read.parquet(table).select(*EVENT_KEY)
    assert 0 < before <= got.count()
    assert sorted_rows(got) == sorted_rows(silver.valid_events(small.bronze).select(*EVENT_KEY).distinct())
    # Started once more, it finds nothing new.
    dedupe.run_event_dedupe(*arguments)
    assert spark.read.parquet(table).count() == got.count()


def test_late_rows_are_counted_and_listed(spark, small, stream):
    landing, table, checkpoint = stream
    newer = F.col("event_time") >= F.lit("2024-03-01").cast("timestamp")
    counted = 0
    for part in (small.delivery(0).where(newer), small.delivery(0).where(~newer)):
        part.write.mode("append").parquet(landing)
        counted += dedupe.run_event_dedupe(spark, landing, small.bronze.schema, table, checkpoint, "20 days")
    landed = spark.read.schema(small.bronze.schema).parquet(landing)
    late = dedupe.late_events(landed, spark.read.parquet(table))
    valid = silver.valid_events(landed)
    assert late.count() == counted > 100
    assert late.agg(F.max("event_time")).first()[0] <= valid.agg(F.expr("max(event_time) - INTERVAL 20 DAYS")).first()[0]
    assert late.count() + spark.read.parquet(table).count() == valid.select(*EVENT_KEY).distinct().count()


# --- summaries under change ---------------------------------------------------------------------

SUMMARY = rollups.Summary(("part", "kind"), ("a", "b"), ("a",))
SCHEMA = "part string, kind string, a long, b long"


def rebuilt(spark, rows):
    return sorted_rows(SUMMARY.read(SUMMARY.delta(rollups.inserted(spark.createDataFrame(rows, SCHEMA)))))


def state_of(spark, path):
    return sorted_rows(rollups.read_summary(spark, path, SUMMARY))


def some_row(rng):
    return (rng.choice("xyz"), rng.choice(["k", "l", None]), rng.choice([None, 1, 2, 3]), rng.randrange(9))


def test_summary_after_changes_equals_rebuild(spark):
    rng, path, rows = random.Random(2), scratch_path(spark, "summary"), []
    for batch in range(1, 6):
        after = rng.sample(rows, len(rows) * 2 // 3) + [some_row(rng) for _ in range(15)]
        if batch == 5:
            after = [r for r in after if r[0] != "y"]
        older, current = (spark.createDataFrame(r, SCHEMA) for r in (rows, after))
        changes = rollups.signed_changes(older, current)
        # The first time only one partition gets through; the replay finishes the others and leaves it alone.
        if batch > 1:
            rollups.apply_changes(spark, path, SUMMARY, changes.where("part = 'x'"), batch)
        rollups.apply_changes(spark, path, SUMMARY, changes, batch)
        rollups.apply_changes(spark, path, SUMMARY, changes, batch)
        rows = after
        assert state_of(spark, path) == rebuilt(spark, rows)
    assert not any(r[0] == "y" for r in state_of(spark, path))


def test_minimum_survives_a_delete(spark):
    path = scratch_path(spark, "minimum")
    rows = [("x", "k", 1, 0), ("x", "k", 1, 0), ("x", "k", 5, 0), ("y", "k", 9, 0)]
    df = lambda *places: spark.createDataFrame([rows[n] for n in places], SCHEMA)
    rollups.apply_changes(spark, path, SUMMARY, rollups.inserted(df(0, 1, 2, 3)), 1)
    for batch, (place, least) in enumerate([(0, 1), (1, 5)], 2):
        rollups.apply_changes(spark, path, SUMMARY, rollups.deleted(df(place)), batch)
        assert {r["part"]: r["least_a"] for r in rollups.read_summary(spark, path, SUMMARY).collect()} == {"x": least, "y": 9}


def test_only_touched_partitions_are_written(spark):
    path = scratch_path(spark, "touched-summary")
    rows = spark.createDataFrame([("x", "k", 1, 0), ("y", "k", 1, 0)], SCHEMA)
    rollups.apply_changes(spark, path, SUMMARY, rollups.inserted(rows), 1)
    listed = lambda: {(r[0], r[1]) for r in spark.read.parquet(path).select("part", "_metadata.file_path").distinct().collect()}
    before = listed()
    rollups.apply_changes(spark, path, SUMMARY, rollups.inserted(rows.where("part = 'y'")), 2)
    assert {part for part, _ in before ^ listed()} == {"y"}


# --- distinct counts ----------------------------------------------------------------------------


def test_returning_ids_count_once(spark):
    rows = [("a", 1, 5), ("a", 2, 5), ("a", 2, 70_000), ("b", 1, 5), ("b", 1, None), ("b", 2, -3), ("c", 1, None)]
    df = spark.createDataFrame(rows, "kind string, day int, id long")
    halves = [distinct_counts.id_sets(df.where(f"day = {d}"), {"kind": F.col("kind"), "day": F.col("day")}, "id") for d in (1, 2)]
    sets = distinct_counts.merge_sets(*halves, halves[0])
    assert sorted_rows(distinct_counts.distinct_ids(sets, "kind")) == [("a", 2), ("b", 2)]
    assert sorted_rows(distinct_counts.distinct_ids(sets)) == [(3,)]
    assert sorted_rows(distinct_counts.distinct_ids(sets, "day")) == [(1, 1), (2, 3)]


# --- bucketed merges ----------------------------------------------------------------------------


def bucketed(spark, name, rows):
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df = spark.createDataFrame(rows, "k string, v int, t int, day string")
    buckets.create_bucketed(df, name, scratch_path(spark, name), "k", "day", 8)


def test_bucketed_merge_leaves_the_target_in_place(spark):
    bucketed(spark, "bucketed_plan", [(str(n), n, 1, "x") for n in range(500)])
    batch = spark.createDataFrame([("1", 0, 2, "x")], "k string, v int, t int, day string")
    rows = buckets.merged_rows(spark.table("bucketed_plan").select("k", "v", "t", "day"), batch, "k", "t")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan and "SortMergeJoin" in plan


def test_bucketed_merge_by_key(spark):
    bucketed(spark, "bucketed_merge", [("a", 1, 1, "x"), ("b", 1, 3, "x"), ("c", 1, 1, "y"), ("n", 1, 1, None)])
    batch = [("a", 2, 2, "x"), ("a", 0, 0, "x"), ("b", 2, 2, "x"), ("d", 2, 2, "z"), ("m", 2, 2, None)]
    batch = spark.createDataFrame(batch, "k string, v int, t int, day string")
    for _ in range(2):
        buckets.merge_bucketed(spark, "bucketed_merge", batch, "k", "t", "day")
        got = sorted_rows(spark.table("bucketed_merge").select("k", "v", "day"))
        assert got == sorted([("a", 2, "x"), ("b", 1, "x"), ("c", 1, "y"), ("d", 2, "z"), ("m", 2, None), ("n", 1, None)], key=str)
    buckets.merge_bucketed(spark, "bucketed_merge", batch.where("false"), "k", "t", "day")
    buckets.merge_bucketed(spark, "bucketed_merge", spark.createDataFrame([("c", 5, "y")], "k string, t int, day string"), "k", "t", "day")
    assert spark.table("bucketed_merge").where("k = 'c'").collect()[0]["v"] is None
    assert spark.table("bucketed_merge").count() == 6


# --- batches in any order -----------------------------------------------------------------------


@pytest.mark.parametrize("order", [[1, 0, 2], [2, 1, 0], [0, 2, 2, 1, 1]])
def test_batches_in_any_order(spark, order):
    schema = "k string, v int, day string, _ingestion_time int, _batch_id string"
    batches = [[("a", 0, "x", 1, "b0"), ("b", 0, "x", 1, "b0")], [("a", 1, "x", 2, "b1")], [("b", 2, "x", 3, "b2"), ("c", 2, "y", 3, "b2")]]
    path, listed, seen = scratch_path(spark, "order"), scratch_path(spark, "order-ledger"), []
    for number in order:
        seen += batches[number]
        source = spark.createDataFrame(seen, schema)
        ledger.load_new_batches(spark, source, lambda rows: rows, path, listed, "k", "_ingestion_time", "day")
    assert sorted_rows(read_if_written(spark, path).select("k", "v")) == [("a", 1), ("b", 2), ("c", 2)]
    entries = spark.read.parquet(listed)
    assert sorted_rows(entries.select("_batch_id")) == [("b0",), ("b1",), ("b2",)]


# --- branches, positions, rejected lines ----------------------------------------------------------


def test_ancestors_follow_the_branch(spark):
    log = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 2), (5, 4)], "snapshot_id long, parent_id long")
    chain = lambda current: sorted(r[0] for r in versions.ancestors(log, current).collect())
    assert [chain(n) for n in (1, 3, 5)] == [[1], [1, 2, 3], [1, 2, 4, 5]]


def test_positions_of_a_sorted_table(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("n"), F.lit(1).alias("m")).repartition(7)
    placed = ranking.add_positions(df, "n", name="place")
    assert placed.columns == ["n", "m", "place"] and placed.where("place <> n + 1").count() == 0
    assert ranking.add_positions(df.where("false"), "n").isEmpty()


def test_rejected_lines_are_kept_apart(spark, folder):
    lines = ["a,b,c", "1,x,2.5", "2,y", "3,z,1,9", "four,x,1", '5,"quoted, text",', ",,", "6,x,none"]
    with open(f"{folder}/in.csv", "w") as out:
        out.write("\n".join(lines))
    schema = files.T.StructType([files.T.StructField(n, t()) for n, t in (("a", files.T.LongType), ("b", files.T.StringType), ("c", files.T.DoubleType))])
    table, quarantine = f"{folder}/table", f"{folder}/quarantine"
    counts = files.ingest_checked(spark, f"{folder}/in.csv", schema, table, quarantine).first()
    assert tuple(counts) == (3, 4, 7)
    assert sorted_rows(spark.read.parquet(table)) == sorted([(1, "x", 2.5), (5, "quoted, text", None), (None, None, None)], key=str)
    assert {r[0] for r in spark.read.parquet(quarantine).select("rejected_line").collect()} == {"2,y", "3,z,1,9", "four,x,1", "6,x,none"}
    assert schema.names == ["a", "b", "c"]


# --- judged batches, columns by identity -----------------------------------------------------------


def test_gate_shows_accepted_batches_only(spark):
    schema = "k string, v int, kind string"
    tests = gate.Gate(spark, scratch_path(spark, "gate-test"), "k", ["k", "v"], {"kind": ["x", "y"]})
    batches = [
        ([("a", 1, "x"), ("b", 2, None)], True),
        ([("a", 1, "x")], False),
        ([("c", 1, "x"), ("c", 2, "x")], False),
        ([("d", None, "x"), (None, 1, "z")], False),
        ([("e", 1, "y")], True),
    ]
    for number, (rows, accepted) in enumerate(batches):
        for _ in range(2):
            assert tests.write(spark.createDataFrame(rows, schema), number) == accepted
    assert sorted_rows(tests.read().select("k")) == [("a",), ("b",), ("e",)]
    failures = {(r["batch"], r["test"], r["column_name"]): r["failures"] for r in tests.results().collect()}
    assert {key: n for key, n in failures.items() if n} == {
        (1, "unique", "k"): 1,
        (2, "unique", "k"): 1,
        (3, "not_null", "k"): 1,
        (3, "not_null", "v"): 1,
        (3, "accepted_values", "kind"): 1,
    }


def test_columns_follow_their_identity(spark, folder):
    old = spark.createDataFrame([(1, "p", 7)], "a int, b string, gone int")
    new = spark.createDataFrame([(2**40, "q", "r")], "wide long, renamed string, b string")
    ids = {"wide": 1, "renamed": 2, "b": 4}
    versions.with_field_ids(old, {"a": 1, "b": 2, "gone": 3}).write.parquet(f"{folder}/old")
    versions.with_field_ids(new, ids).write.parquet(f"{folder}/new")
    rows = versions.read_by_id(spark, [f"{folder}/old", f"{folder}/new"], new.schema, ids)
    assert sorted_rows(rows) == [(1, "p", None), (2**40, "q", "r")]
