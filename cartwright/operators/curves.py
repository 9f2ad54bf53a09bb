"""Tables clustered by several columns at once, so that a filter on any of them skips files.

Each column is cut into 2 ** bits parts of about equal size. A row's key interleaves the bits of its parts (the Z-order
curve), and the table is ranged and sorted by that key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 5


def with_key(df: DataFrame, columns: list[str], name: str, bits: int = BITS) -> DataFrame:
    """Adds the key. A part is a number from 0 to 2 ** bits - 1; null is in part 0.

    The columns are numbers, dates or times. One aggregate finds the cuts, at most 2 ** bits - 1 a column.
    """
    shares = F.array(*[F.lit(k / (1 << bits)) for k in range(1, 1 << bits)])
    cuts = {f"{name}_cuts_{k}": df.select(F.percentile_approx(c, shares)).scalar() for k, c in enumerate(columns)}

    def part(column: str, held: str) -> Column:
        reached = F.size(F.filter(held, lambda cut: cut <= F.col(column)))
        return F.when(F.col(column).isNull() | F.col(held).isNull(), 0).otherwise(reached).cast("long")

    parts = [part(column, held) for column, held in zip(columns, cuts)]
    return df.withColumns(cuts).withColumn(name, interleave(parts, bits)).drop(*cuts)


def interleave(parts: list[Column], bits: int = BITS) -> Column:
    """The bits of the parts in turn, highest first, as one number of at most 63 bits."""
    if bits * len(parts) > 63:
        raise ValueError("too many bits for one key")
    places = [
        F.shiftleft(F.shiftright(part, bit).bitwiseAND(F.lit(1).cast("long")), bit * len(parts) + len(parts) - 1 - k)
        for bit in range(bits)
        for k, part in enumerate(parts)
    ]
    return reduce(Column.bitwiseOR, places)


def write_clustered(df: DataFrame, path: str, *columns: str, bits: int = BITS, files: int | None = None) -> None:
    """Writes the table clustered by all of `columns`; a hash ends the range key, so that one hot key fills several files."""
    key, spread = "_curve_key", F.xxhash64(*[F.col(c) for c in df.columns])
    keyed = with_key(df, list(columns), key, bits)
    ranged = keyed.repartitionByRange(files, key, spread) if files else keyed.repartitionByRange(key, spread)
    ranged.sortWithinPartitions(key).drop(key).write.mode("overwrite").parquet(path)


def file_ranges(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """file, row_count and, for each column, its least and greatest value in the file."""
    ends = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("least", F.min), ("greatest", F.max))]
    rows = spark.read.parquet(path).select(*columns, F.col("_metadata.file_path").alias("file"))
    return rows.groupBy("file").agg(F.count(F.lit(1)).alias("row_count"), *ends)


def skipped_share(ranges: DataFrame, column: str, low: object, high: object) -> DataFrame:
    """The share of rows in files that a filter `column BETWEEN low AND high` need not read."""
    needed = (F.col(f"greatest_{column}") >= F.lit(low)) & (F.col(f"least_{column}") <= F.lit(high))
    read = F.sum(F.when(needed, F.col("row_count")).otherwise(0))
    return ranges.agg((1 - read / F.sum("row_count")).alias("skipped"))
