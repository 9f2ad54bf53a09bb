"""Tables clustered by several columns."""

from pyspark.sql import functions as F

from cartwright.operators import curves
from cartwright.session import scratch_path


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_bits_take_turns(spark):
    row = spark.range(1).select(curves.interleave([F.lit(0b110).cast("long"), F.lit(0b011).cast("long")], 3).alias("key")).first()
    assert row["key"] == 0b101101


def test_filters_on_either_column_skip_files(spark):
    grid = spark.range(4096).select((F.col("id") % 64).alias("a"), F.floor(F.col("id") / 64).alias("b"), F.col("id").alias("row"))
    path, plain = scratch_path(spark, "curve-test"), scratch_path(spark, "plain-test")
    curves.write_clustered(grid, path, "a", "b", files=16)
    grid.repartitionByRange(16, "a").write.parquet(plain)
    assert sorted_rows(spark.read.parquet(path)) == sorted_rows(grid)
    share = lambda at, column: curves.skipped_share(curves.file_ranges(spark, at, "a", "b"), column, 8, 11).first()["skipped"]
    assert share(path, "a") > 0.5 and share(path, "b") > 0.5
    assert share(plain, "a") > 0.5 and share(plain, "b") == 0


def test_nulls_ties_and_empty_tables_stay_whole(spark):
    rows = [(None, 1.5), (None, None), (3, 2.5), (3, 2.5), (3, None)]
    for held in (rows, rows[:2], []):
        table = spark.createDataFrame(held, "a long, b double")
        path = scratch_path(spark, "curve-test")
        curves.write_clustered(table, path, "a", "b")
        assert sorted_rows(spark.read.parquet(path)) == sorted_rows(table)
