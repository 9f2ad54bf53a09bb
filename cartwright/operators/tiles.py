"""Quantile tiles (`ntile`) that are kept up to date without sorting the rows that were there before.

The state is a parquet folder. `rows` holds signed values, partitioned by batch, measure and bin; `bins` holds how many rows
each batch added to each bin. A bin is a range of values, about a quarter of a power of two, so there are at most some
500 per measure whatever the data. The first row of a tile lies in one bin, which the counts name. Only the rows of
these boundary bins are read again: they are counted by ever narrower ranges of the value, and of the tie among equal values,
until one row is left. Nothing is sorted, and a hot value is counted by its ties, with partial counts in each task.

Changes carry a sign as in `rollups`: +1 for a row that came, -1 for one that went. A replayed batch replaces its own folders.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.operators.ranking import tile_by_cuts, tile_starts

#: The bin of null, after all others.
MISSING = 1000

#: Ranges that an open interval is divided into in one round; bounds what a round brings to the driver.
RANGES = 1024

ROWS = "value long, tie long, sign long, batch long, measure string, bin int"
BINS = "n long, least long, most long, least_tie long, most_tie long, batch long, measure string, bin int"


@dataclass(frozen=True)
class Tiling:
    """Columns of whole numbers to tile, ascending with null last, and the unique whole number that orders equal values."""

    measures: tuple[str, ...]
    tie: str
    tiles: int


@dataclass(frozen=True)
class _Interval:
    """Where the row with `rank` (from 0) among those of the interval lies."""

    measure: str
    cut: int
    bin: int
    low: int
    high: int
    low_tie: int
    high_tie: int
    rank: int

    @property
    def is_open(self) -> bool:
        return self.low < self.high or self.low_tie < self.high_tie

    @property
    def by_value(self) -> bool:
        return self.low < self.high

    @property
    def start(self) -> int:
        return self.low if self.by_value else self.low_tie

    @property
    def end(self) -> int:
        return self.high if self.by_value else self.high_tie

    @property
    def width(self) -> int:
        return -(-(self.end - self.start + 1) // RANGES)

    def narrowed(self, counts: dict[int, int]) -> _Interval:
        place, rank = _find(sorted(counts.items()), self.rank)
        start = self.start + place * self.width
        end = min(self.end, start + self.width - 1)
        if self.by_value:
            return replace(self, low=start, high=end, rank=rank)
        return replace(self, low_tie=start, high_tie=end, rank=rank)


def _find(counts: list[tuple], rank: int) -> tuple:
    """The entry that holds the row with this rank, and its rank within the entry."""
    for entry, n in counts:
        if rank < n:
            return entry, rank
        rank -= n
    raise ValueError("the changes do not match the rows they were applied to")


def value_bin(value: Column) -> Column:
    """The bin of a whole number above -2^63: its sign, its number of bits and the two bits after the first."""
    digits = F.bin(F.abs(value))
    step = F.conv(F.rpad(F.substring(digits, 2, 2), 2, "0"), 2, 10).cast("int")
    place = F.length(digits) * 4 + step
    return F.when(value.isNull(), MISSING).when(value < 0, -place).otherwise(place).cast("int")


def apply_batch(spark: SparkSession, path: str, tiling: Tiling, changes: DataFrame, batch: int) -> None:
    """Adds a batch to the state at `path`: the tie, the measures and `sign`.

    Ties are never null and differ by less than 2^63. Only the batch is shuffled; earlier batches are not read. A replay,
    also of a batch that was interrupted, gives the same state. An empty batch adds nothing.
    """
    entries = [F.struct(F.lit(m).alias("measure"), F.col(m).cast("long").alias("value")) for m in tiling.measures]
    listed = changes.select(F.col(tiling.tie).cast("long").alias("tie"), "sign", F.explode(F.array(*entries)).alias("entry"))
    _write_batch(spark, path, listed.select("entry.*", "tie", "sign"), batch)


def _write_batch(spark: SparkSession, path: str, entries: DataFrame, batch: int) -> None:
    place = value_bin(F.col("value")).alias("bin")
    valued = entries.select("measure", place, F.coalesce("value", F.lit(0)).alias("value"), "tie", "sign")
    # A row whose other columns changed comes and goes with the same value.
    summed = valued.groupBy("measure", "bin", "value", "tie").agg(F.sum("sign").cast("long").alias("sign")).where(F.col("sign") != 0)
    rows = f"{path}/rows/batch={int(batch)}"
    summed.hint("rebalance", "measure", "bin").write.mode("overwrite").partitionBy("measure", "bin").parquet(rows)
    written = spark.read.schema("value long, tie long, sign long, measure string, bin int").parquet(rows)
    bins = written.groupBy("measure", "bin").agg(
        F.sum("sign").alias("n"),
        F.min("value").alias("least"),
        F.max("value").alias("most"),
        F.min("tie").alias("least_tie"),
        F.max("tie").alias("most_tie"),
    )
    bins.coalesce(1).write.mode("overwrite").parquet(f"{path}/bins/batch={int(batch)}")


def _all_bins(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BINS).parquet(f"{path}/bins")


def _counted_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the batches that were finished."""
    rows = spark.read.schema(ROWS).parquet(f"{path}/rows")
    return rows.join(_all_bins(spark, path).select("batch").distinct(), "batch", "left_semi")


def _boundaries(spark: SparkSession, path: str, tiling: Tiling) -> list[_Interval]:
    """The bins that hold the first rows of tiles 2..k."""
    bins = _all_bins(spark, path).groupBy("measure", "bin").agg(
        F.sum("n").alias("n"), F.min("least"), F.max("most"), F.min("least_tie"), F.max("most_tie")
    )
    found: dict[str, list[tuple]] = {m: [] for m in tiling.measures}
    for measure, place, n, *bounds in bins.orderBy("measure", "bin").collect():
        found[measure].append(((place, *bounds), n))
    intervals = []
    for measure, counts in found.items():
        for cut, start in enumerate(tile_starts(sum(n for _, n in counts), tiling.tiles)):
            (place, *bounds), rank = _find(counts, start)
            intervals.append(_Interval(measure, cut, place, *bounds, rank))
    return intervals


def _narrow(rows: DataFrame, intervals: list[_Interval]) -> list[_Interval]:
    """One round for all open intervals: a count of their rows by range."""
    spark = rows.sparkSession
    listed = [(x.measure, x.bin, x.cut, x.low, x.high, x.low_tie, x.high_tie, x.start, x.width) for x in intervals]
    schema = "measure string, bin int, cut int, low long, high long, low_tie long, high_tie long, start long, width long"
    # One row for each cut of each measure, whatever the data.
    wanted = F.broadcast(spark.createDataFrame(listed, schema))
    bins = " OR ".join(f"(measure = '{m}' AND bin = {b})" for m, b in sorted({(x.measure, x.bin) for x in intervals}))
    inside = F.col("value").between(F.col("low"), F.col("high")) & F.col("tie").between(F.col("low_tie"), F.col("high_tie"))
    place = F.when(F.col("low") < F.col("high"), F.col("value")).otherwise(F.col("tie"))
    hits = rows.where(bins).join(wanted, ["measure", "bin"]).where(inside).withColumn("place", place)
    counts: dict[tuple[str, int], dict[int, int]] = {(x.measure, x.cut): {} for x in intervals}
    for measure, cut, part, n in hits.groupBy("measure", "cut", F.expr("(place - start) div width")).agg(F.sum("sign")).collect():
        counts[measure, cut][part] = n
    return [x.narrowed(counts[x.measure, x.cut]) for x in intervals]


def cut_rows(spark: SparkSession, path: str, tiling: Tiling) -> dict[str, list[tuple[int, int, int]]]:
    """Null flag, value and tie of the first row of tiles 2..k of each measure; fewer where there are fewer rows."""
    intervals = _boundaries(spark, path, tiling)
    rows = _counted_rows(spark, path)
    while waiting := [x for x in intervals if x.is_open]:
        intervals = [x for x in intervals if not x.is_open] + _narrow(rows, waiting)
    cuts: dict[str, list[tuple[int, int, int]]] = {m: [] for m in tiling.measures}
    for x in sorted(intervals, key=lambda x: x.cut):
        cuts[x.measure].append((int(x.bin == MISSING), x.low, x.low_tie))
    return cuts


def add_kept_tiles(df: DataFrame, path: str, tiling: Tiling, names: dict[str, str]) -> DataFrame:
    """Adds the tile of each row of `df`, the rows that the state counts; `names` gives the column for each measure."""
    cuts = cut_rows(df.sparkSession, path, tiling)
    return df.withColumns({name: tile_by_cuts(F.col(m), F.col(tiling.tie), cuts[m]) for m, name in names.items()})


def compact(spark: SparkSession, path: str, new_path: str, batch: int) -> None:
    """Writes what all batches add up to as one batch at `new_path`; rows that came and went are no longer there."""
    value = F.when(F.col("bin") != MISSING, F.col("value")).alias("value")
    _write_batch(spark, new_path, _counted_rows(spark, path).select("measure", value, "tie", "sign"), batch)
