"""Exact distinct counts that can be merged and rolled up.

The state of a group is the set of its ids as bitmaps: a bucket of 32 768 neighbouring ids is one row with 4 KB of bits. Sets of
two batches, or of the days of a month, merge by OR, so that an id that returns counts once; plain counts per day can't be
added. A bitmap is worth its size where ids are handed out in sequence, as customer numbers are; ids far apart take a
bucket each. Null ids are not counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_sets(df: DataFrame, keys: dict[str, Column], id_column: str) -> DataFrame:
    """The keys, bucket and bits of the ids of each group."""
    number = F.col(id_column)
    known = df.where(number.isNotNull()).select(*[c.alias(n) for n, c in keys.items()], number.cast("long").alias("id"))
    grouped = known.groupBy(*keys, F.bitmap_bucket_number("id").alias("bucket"))
    return grouped.agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def merge_sets(*states: DataFrame) -> DataFrame:
    """The union of the sets, group by group."""
    both = states[0]
    for state in states[1:]:
        both = both.unionByName(state)
    return both.groupBy(*[c for c in both.columns if c != "bits"]).agg(F.bitmap_or_agg("bits").alias("bits"))


def rolled_up(state: DataFrame, *keys: str) -> DataFrame:
    """The sets of coarser groups."""
    return state.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_ids(state: DataFrame, *keys: str, name: str = "distinct_ids") -> DataFrame:
    """The number of different ids of each group of `keys`, which may be coarser than those of the state."""
    counted = rolled_up(state, *keys).select(*keys, F.bitmap_count("bits").alias("n"))
    return counted.groupBy(*keys).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias(name))
