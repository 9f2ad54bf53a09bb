"""Tiles that are kept up to date equal `ntile` over the rows that are left."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwright.operators import rollups, tiles
from cartwright.session import scratch_path

SCHEMA = "id long, spent long, days long"
TILING = tiles.Tiling(("spent", "days"), "id", 5)
NAMES = {"spent": "m", "days": "r"}


def expected(df):
    by = lambda c: Window.orderBy(F.col(c).asc_nulls_last(), "id")
    return df.withColumns({name: F.ntile(5).over(by(c)) for c, name in NAMES.items()})


def ordered(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def people(spark, chance, ids):
    """Skewed amounts, negative ones and nulls; two thirds of all share one number of days."""
    rows = []
    for key in ids:
        spent = None if chance.random() < 0.05 else int(chance.paretovariate(0.4) * chance.choice([1, 1, 1, -1]))
        rows.append((key, spent, 7 if chance.random() < 0.66 else chance.randrange(-50, 400)))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_replays_and_deletes_equal_ntile(spark, seed):
    chance, path = random.Random(seed), scratch_path(spark, "tiles")
    older = people(spark, chance, chance.sample(range(-10**12, 10**12), 400))
    moved = older.sample(0.3, seed).withColumn("spent", F.col("spent") * 3 + 1)
    current = older.join(moved, "id", "left_anti").unionByName(moved).unionByName(people(spark, chance, range(10**13, 10**13 + 60)))
    tiles.apply_batch(spark, path, TILING, rollups.inserted(older), 1)
    assert ordered(tiles.add_kept_tiles(older, path, TILING, NAMES)) == ordered(expected(older))
    for _ in range(2):
        tiles.apply_batch(spark, path, TILING, rollups.signed_changes(older, current), 2)
    assert ordered(tiles.add_kept_tiles(current, path, TILING, NAMES)) == ordered(expected(current))
    gone = F.col("id") % 3 == 0
    tiles.apply_batch(spark, path, TILING, rollups.deleted(current.where(gone)), 3)
    left = current.where(~gone)
    assert ordered(tiles.add_kept_tiles(left, path, TILING, NAMES)) == ordered(expected(left))
    cuts = tiles.cut_rows(spark, path, TILING)
    tiles.compact(spark, path, f"{path}-compact", 3)
    assert tiles.cut_rows(spark, f"{path}-compact", TILING) == cuts
    assert spark.read.parquet(f"{path}-compact/rows").count() == 2 * left.count()


def test_few_rows_and_none(spark):
    path = scratch_path(spark, "tiles")
    none = spark.createDataFrame([], SCHEMA)
    tiles.apply_batch(spark, path, TILING, rollups.inserted(none), 1)
    assert tiles.cut_rows(spark, path, TILING) == {"spent": [], "days": []}
    few = spark.createDataFrame([(1, None, 3), (2, None, 3), (3, 5, None)], SCHEMA)
    tiles.apply_batch(spark, path, TILING, rollups.inserted(few), 2)
    assert ordered(tiles.add_kept_tiles(few, path, TILING, NAMES)) == ordered(expected(few))


def test_an_interrupted_batch_does_not_count(spark):
    path = scratch_path(spark, "tiles")
    first, second = (people(spark, random.Random(s), range(s * 1000, s * 1000 + 50)) for s in (1, 2))
    tiles.apply_batch(spark, path, TILING, rollups.inserted(first), 1)
    before = tiles.cut_rows(spark, path, TILING)
    # The rows of a batch whose counts were not written.
    stray = spark.read.parquet(f"{path}/rows/batch=1")
    stray.write.partitionBy("measure", "bin").parquet(f"{path}/rows/batch=2")
    assert tiles.cut_rows(spark, path, TILING) == before
    tiles.apply_batch(spark, path, TILING, rollups.inserted(second), 2)
    both = first.unionByName(second)
    assert ordered(tiles.add_kept_tiles(both, path, TILING, NAMES)) == ordered(expected(both))


def test_bins_keep_the_order(spark):
    values = sorted({sign * (2**k + d) for k in range(62) for d in (-1, 0, 1, 2**k // 3) for sign in (1, -1)})
    df = spark.createDataFrame([(v,) for v in values], "value long")
    bins = [r[0] for r in df.select(tiles.value_bin(F.col("value")), "value").orderBy("value").collect()]
    assert bins == sorted(bins) and max(bins) < tiles.MISSING and len(set(bins)) <= 510
