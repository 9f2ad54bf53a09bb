"""Whole-table ranks without a whole-table window, checked joins, and the shape of plans."""

import datetime
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwright.operators.dedupe import EVENT_KEY, latest_per_key
from cartwright.operators.joins import dimension_join
from cartwright.operators.ranking import add_dense_ranks, add_ntiles
from cartwright.operators.sinks import write_clustered
from cartwright.plans import gold, silver


def plan_of(df):
    return df._jdf.queryExecution().toString()


def numbers(spark, rows, distinct, seed, nulls=0):
    rng = random.Random(seed)
    ids = rng.sample(range(10 * rows), rows)
    return spark.createDataFrame([(i, None if n < nulls else rng.randrange(distinct)) for n, i in enumerate(ids)], "id long, x long")


@pytest.mark.parametrize(
    "rows, distinct, tiles, nulls",
    [(3, 5, 5, 0), (5, 1, 5, 1), (7, 3, 5, 2), (1001, 4, 5, 0), (1000, 1000, 7, 300), (997, 1, 3, 996), (4, 9, 3, 4), (1, 1, 5, 0)],
)
def test_ntile_equals_window(spark, rows, distinct, tiles, nulls):
    df = numbers(spark, rows, distinct, rows, nulls)
    got = add_ntiles(df, tiles, {"t": F.col("x"), "down": -F.col("x")}, "id")
    up, down = Window.orderBy(F.col("x").asc_nulls_last(), "id"), Window.orderBy(F.col("x").desc(), "id")
    expected = df.withColumn("t", F.ntile(tiles).over(up)).withColumn("down", F.ntile(tiles).over(down))
    assert got.exceptAll(expected).isEmpty() and got.count() == rows


@pytest.mark.parametrize("rows, distinct, nulls", [(1, 1, 0), (1, 1, 1), (500, 3, 2), (1000, 400, 1), (6, 3, 6)])
def test_dense_rank_equals_window(spark, rows, distinct, nulls):
    df = numbers(spark, rows, distinct, rows + 1, nulls)
    got = add_dense_ranks(df, {"r": F.col("x")})
    expected = df.withColumn("r", F.dense_rank().over(Window.orderBy(F.col("x").desc())))
    assert got.select("id", "x", "r").exceptAll(expected).isEmpty() and got.count() == rows


def test_ranks_of_an_empty_table(spark):
    df = numbers(spark, 3, 3, 1).limit(0)
    assert add_ntiles(df, 5, {"t": F.col("x")}, "id").count() == add_dense_ranks(df, {"r": F.col("x")}).count() == 0


def test_customer_without_a_date_comes_last(spark):
    """The recency of such a customer is null, which a descending order puts last, in the highest tile."""
    days = [datetime.date(2024, 1, 1 + n) for n in range(6)] + [None]
    rows = [(n, day, 10.0 + n, "purchase", n) for n, day in enumerate(days)]
    events = spark.createDataFrame(rows, "user_id long, event_date date, price double, event_type string, product_id long")
    got = {r["user_id"]: r for r in gold.customer_rfm(events).collect()}
    by_recency = Window.orderBy(F.col("recency").desc(), "user_id")
    expected = {r["user_id"]: r["t"] for r in gold.rfm_base(events).withColumn("t", F.ntile(5).over(by_recency)).collect()}
    assert {user: row["r_score"] for user, row in got.items()} == expected
    assert got[6]["recency"] is None and got[6]["r_score"] == 5 and got[6]["rfm_string"] == "555"
    assert {row["segment_date"] for row in got.values()} == {datetime.date(2024, 1, 6)}


def test_scores_of_many_customers(spark):
    """All orders as purchases, against the window."""
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").select(
        F.col("o_custkey").alias("user_id"),
        F.to_date("o_orderdate").alias("event_date"),
        F.col("o_totalprice").alias("price"),
        F.lit("purchase").alias("event_type"),
        F.col("o_orderkey").alias("product_id"),
    )
    got = gold.customer_rfm(orders)
    expected = got.withColumns(
        {
            "r_score": F.ntile(5).over(Window.orderBy(F.col("recency").desc(), "user_id")),
            "f_score": F.ntile(5).over(Window.orderBy("frequency", "user_id")),
            "m_score": F.ntile(5).over(Window.orderBy("monetary", "user_id")),
        }
    )
    assert got.count() > 900 and got.exceptAll(expected).isEmpty()


def test_ranks_have_no_single_task_stage(spark, small):
    df = numbers(spark, 300, 50, 1)
    ranked = add_dense_ranks(add_ntiles(df, 5, {"t": F.col("x")}, "id"), {"r": F.col("x")})
    for plan in map(plan_of, (ranked, gold.customer_rfm(small.silver), gold.product_ranks(small.performance.drop("revenue_rank", "purchase_rank")))):
        assert "ENSURE_REQUIREMENTS" in plan or "SinglePartition" not in plan
        assert "Window" not in plan


def test_dedupe_limits_copies_before_the_shuffle(spark, small):
    plan = plan_of(latest_per_key(small.bronze, EVENT_KEY, ["_ingestion_time"]))
    physical = plan[plan.index("== Physical Plan ==") :]
    assert "row_number(), 1, Partial" in physical
    assert physical.index("row_number(), 1, Final") < physical.index("row_number(), 1, Partial")


def test_hot_key_dedupe(spark):
    copies = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("key"), F.col("id").alias("version")
    )
    got = latest_per_key(copies, ["key"], ["version"])
    assert got.count() == copies.select("key").distinct().count()
    assert got.where("key = -1").first()["version"] == 19_998


def test_purchase_filter_and_columns_reach_the_scan(small):
    plan = plan_of(gold.daily_sales(small.silver))
    physical = plan[plan.index("== Physical Plan ==") :]
    assert "EqualTo(event_type,purchase)" in physical
    read = physical[physical.index("ReadSchema") :]
    assert "user_session" not in read and "brand" not in read


def test_valid_filter_runs_before_the_shuffle(small):
    plan = plan_of(silver.events_cleaned(silver.deduplicated(small.lake["bronze.events_raw"])))
    physical = plan[plan.index("== Physical Plan ==") :]
    assert "IsNotNull(user_id)" in physical and "IsNotNull(product_id)" in physical


def test_funnel_needs_no_row_expansion(small):
    plan = plan_of(gold.funnel_daily(small.silver))
    assert "Expand" not in plan[plan.index("== Physical Plan ==") :]


def test_dimension_join_keeps_every_fact(spark):
    fact = spark.range(500).select(F.col("id"), F.when(F.col("id") % 5 > 0, F.col("id") % 20).alias("k"))
    dimension = spark.range(100).select(F.col("id").alias("d"), (F.col("id") * 2).alias("twice"))
    joined = dimension_join(fact, dimension, "k", "d")
    assert joined.count() == 500
    assert joined.where("k IS NOT NULL AND twice <> 2 * k").isEmpty()
    assert joined.where("(k IS NULL) <> (twice IS NULL)").isEmpty()


def test_both_clean_tables_share_one_dedupe(spark, small):
    """The history is deduplicated once; neither clean table windows over it again."""
    kept = small.lake["silver.events_deduplicated"]
    for table in (silver.events_cleaned(kept), silver.stg_events(kept)):
        plan = plan_of(table)
        assert "Window" not in plan and "Exchange" not in plan[plan.index("== Physical Plan ==") :]


def test_files_follow_the_partitions(spark, folder):
    """Many tasks write few partitions: the number of files depends on their size, not on the tasks."""
    df = spark.range(0, 6000, 1, 60).select("id", (F.col("id") % 3).alias("month"), F.lit("view").alias("event_type"))
    write_clustered(df, f"{folder}/t", ["month"], ["event_type"])
    files = spark.read.parquet(f"{folder}/t").groupBy("month").agg(F.count_distinct("_metadata.file_path").alias("n"))
    assert {r["n"] for r in files.collect()} == {1}
