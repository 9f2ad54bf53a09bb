"""Whole-table `ntile` and `dense_rank` without pulling the table into one task.

A window without a partition column sorts all rows in a single task. Here the rows are range partitioned and
sorted, every row gets its position within its partition, and the partition sizes (one number per partition)
turn positions into ranks over the whole table. Nulls come last in either order, as they do where the
ranking sorts its values downwards.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.session import materialise, run_together

# monotonically_increasing_id keeps the partition number above bit 33.
PARTITION_BITS = 33


def _sort_keys(value: Column) -> tuple[Column, Column]:
    """A numeric value as two columns without nulls that sort nulls last."""
    return value.isNull().cast("int"), F.coalesce(value, F.lit(0))


def _positions(df: DataFrame, keys: list[str]) -> tuple[DataFrame, dict[int, int], int]:
    """`df` with a sorted `position`, the number of rows before each partition, and the number of rows."""
    table = materialise(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("position", F.monotonically_increasing_id()),
        "positions",
    )
    sizes = table.groupBy(F.shiftright("position", PARTITION_BITS).alias("partition")).count().collect()
    ordered = sorted((row["partition"], row["count"]) for row in sizes)
    before = accumulate((count for _, count in ordered), initial=0)
    starts = {partition: start for (partition, _), start in zip(ordered, before)}
    return table, starts, sum(count for _, count in ordered)


def add_positions(df: DataFrame, *keys: str, name: str = "position") -> DataFrame:
    """Adds the place, from 1, of each row in the order of the keys, nulls first; rows with equal keys in any order."""
    table, before, _ = _positions(df, list(keys))
    starts = df.sparkSession.createDataFrame(list(before.items()), "partition long, first long")
    place = F.col("first") + F.col("position").bitwiseAND(F.lit((1 << PARTITION_BITS) - 1)) + 1
    placed = table.join(starts, F.shiftright("position", PARTITION_BITS) == F.col("partition"))
    return placed.select(*df.columns, place.alias(name))


def tile_starts(rows: int, tiles: int) -> list[int]:
    """0-based rank of the first row of tiles 2..k; the first `rows % tiles` tiles hold one row more."""
    size, extra = divmod(rows, tiles)
    starts = [tile * size + min(tile, extra) for tile in range(1, tiles)]
    return [start for start in starts if start < rows]


def _cut_rows(df: DataFrame, value: Column, tie: str, tiles: int) -> list[tuple]:
    """The sort keys and tie of the first row of tiles 2..k."""
    missing, known = _sort_keys(value)
    keys = ["missing", "known", "tie"]
    table, before, rows = _positions(df.select(missing.alias("missing"), known.alias("known"), F.col(tie).alias("tie")), keys)
    wanted = []
    for start in tile_starts(rows, tiles):
        partition = max((p for p, first in before.items() if first <= start), key=lambda p: before[p])
        wanted.append((partition << PARTITION_BITS) + start - before[partition])
    found = table.where(F.col("position").isin(wanted)).orderBy("position").collect()
    return [(row["missing"], row["known"], row["tie"]) for row in found]


def tile_by_cuts(value: Column, tie: Column, cuts: list[tuple]) -> Column:
    """The tile of a row, given null flag, value and tie of the first row of each later tile."""
    missing, known = _sort_keys(value)
    tile = F.lit(1)
    for cut_missing, cut_known, cut_tie in cuts:
        later = (known > F.lit(cut_known)) | ((known == F.lit(cut_known)) & (tie >= F.lit(cut_tie)))
        reached = (missing > F.lit(cut_missing)) | ((missing == F.lit(cut_missing)) & later)
        tile = tile + reached.cast("int")
    return tile


def add_ntiles(df: DataFrame, tiles: int, values: dict[str, Column], tie: str) -> DataFrame:
    """Adds one tile number column per numeric entry of `values`, ascending by value, then by the unique `tie`.

    Null values are in the last tiles. Only the first row of each tile is looked up, at most `tiles - 1` rows per
    column, and every row is compared with them: the table itself is not joined or shuffled again.
    """
    df = materialise(df, "ntile-input")
    cuts = run_together(*[lambda v=value: _cut_rows(df, v, tie, tiles) for value in values.values()])
    scores = {name: tile_by_cuts(value, F.col(tie), found) for (name, value), found in zip(values.items(), cuts)}
    return df.withColumns(scores)


def add_dense_ranks(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Adds one dense rank column per numeric entry of `values`, largest value first, null last.

    Only the distinct values are ranked; the ranks are joined back by value. Spark sends a small set of ranks to
    all tasks, and joins a large one by shuffle, where adaptive execution splits a hot value.
    """
    df = materialise(df, "rank-input")
    keys = {name: (f"{name}_missing", f"{name}_key") for name in values}
    for name, value in values.items():
        missing, known = _sort_keys(-value)
        df = df.withColumns({keys[name][0]: missing, keys[name][1]: known})
    ranks = run_together(*[lambda n=name: _value_ranks(df, list(keys[n]), n) for name in values])
    for (name, pair), rank in zip(keys.items(), ranks):
        df = df.join(rank, list(pair), "left")
    return df.drop(*[column for pair in keys.values() for column in pair])


def _value_ranks(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The rank of each distinct value, as a written table."""
    table, before, _ = _positions(df.select(*keys).distinct(), keys)
    starts = df.sparkSession.createDataFrame(list(before.items()), "partition long, start long")
    local = F.col("position").bitwiseAND(F.lit((1 << PARTITION_BITS) - 1))
    # One row per range partition, so this broadcast does not grow with the rows.
    ranked = table.join(F.broadcast(starts), F.shiftright("position", PARTITION_BITS) == F.col("partition"))
    return materialise(ranked.select(*keys, (F.col("start") + local + 1).alias(name)), "ranks")
