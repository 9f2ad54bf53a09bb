"""A Bloom bitmap of fixed size: which rows may be needed in a later pass over the texts.

A row is never missed; a share of the other rows passes too, which a join drops later. The bitmap has at most
2 ** BITS bits (2 MB) however many keys there are, so it can be sent to every task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.session import materialise

BITS = 24


def _words(df: DataFrame, key: Column) -> DataFrame:
    """word and bits of the bitmap of the 64-bit hashes `key`; Spark merges the bits."""
    place = key.bitwiseAND(F.lit((1 << BITS) - 1))
    placed = df.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("bitmap_word"))
    return placed.agg(F.expr("bit_or(shiftleft(1L, cast(place & 63 AS int)))").alias("bitmap_bits"))


def table(df: DataFrame, key: Column) -> DataFrame:
    """The bitmap of the 64-bit hashes `key` as a written table of at most 2 ** (BITS - 6) rows."""
    return materialise(_words(df, key), "bitmap")


def looked_up(df: DataFrame, key: str, words: DataFrame) -> tuple[DataFrame, Column]:
    """`df` joined with the bitmap table, which is sent to all tasks, and whether it may hold the hash column `key`."""
    word = F.shiftright(F.col(key).bitwiseAND(F.lit((1 << BITS) - 1)), 6)
    joined = df.join(F.broadcast(words), word == F.col("bitmap_word"), "left")
    return joined, F.coalesce(F.expr(f"shiftright(bitmap_bits, cast({key} & 63 AS int)) & 1 = 1"), F.lit(False))


def split(df: DataFrame, key: str, keys: DataFrame, among: str) -> tuple[DataFrame, DataFrame]:
    """The rows of `df` whose hash column `key` may be in column `among` of `keys`, and all other rows.

    DataFrame operations only: the bitmap is a table of at most 2 ** (BITS - 6) rows that is sent to all tasks.
    """
    flagged, hit = looked_up(df, key, table(keys, F.col(among)))
    maybe, rest = (flagged.where(test).drop("bitmap_word", "bitmap_bits") for test in (hit, ~hit))
    return maybe, rest


def within(df: DataFrame, key: str, keys: DataFrame, among: str) -> DataFrame:
    """The first part of `split` alone; the other rows are dropped in the join with the bitmap."""
    words = materialise(_words(keys, F.col(among)), "bitmap")
    word = F.shiftright(F.col(key).bitwiseAND(F.lit((1 << BITS) - 1)), 6)
    flagged = df.join(F.broadcast(words), word == F.col("bitmap_word"))
    return flagged.where(F.expr(f"shiftright(bitmap_bits, cast({key} & 63 AS int)) & 1 = 1")).drop("bitmap_word", "bitmap_bits")


def build(df: DataFrame, key: Column) -> np.ndarray:
    """The bitmap of the 64-bit hashes `key` as an array; at most 2 ** (BITS - 6) words arrive here."""
    words = _words(df, key).toArrow()
    bitmap = np.zeros(1 << (BITS - 6), dtype=np.uint64)
    bitmap[words.column(0).to_numpy()] = words.column(1).to_numpy().view(np.uint64)
    return bitmap


def may_hold(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """A flag per key, of any integer type of 64 bits."""
    place = keys.astype(np.uint64) & np.uint64((1 << BITS) - 1)
    return (bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
