"""Summaries that stay right when rows are updated and deleted.

A change is a row with a sign: +1 for a new row, -1 for one that is gone, an update is one of each. Counts and sums add up
with the sign. Minimum and maximum do not, so the state also counts how often each value occurs; the least value whose
count is above zero is the minimum, also after the row that held it is gone.

A state is a parquet table partitioned by the first key. Each partition holds the number of the last batch applied to
it, so a batch that is replayed, or was interrupted between two partitions, changes each partition once. Only the partitions
that a batch touches are read and written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.operators.versions import diff_rows
from cartwright.session import materialise, read_if_written, scratch_scope

#: Names of the rows of the state that hold totals; other rows count the values of the column they are named for.
TOTALS = "*"


def signed_changes(older: DataFrame, current: DataFrame) -> DataFrame:
    """What turned `older` into `current`: its columns and `sign`, which is the number of copies that came or, negative, went."""
    changes = diff_rows(older, current)
    return changes.withColumn("sign", F.when(F.col("change") == "added", F.col("copies")).otherwise(-F.col("copies"))).drop(
        "change", "copies"
    )


def inserted(df: DataFrame) -> DataFrame:
    return df.withColumn("sign", F.lit(1).cast("long"))


def deleted(df: DataFrame) -> DataFrame:
    return df.withColumn("sign", F.lit(-1).cast("long"))


@dataclass(frozen=True)
class Summary:
    """Keys, columns of whole numbers that are summed, and columns whose minimum and maximum are kept."""

    keys: tuple[str, ...]
    sums: tuple[str, ...]
    extremes: tuple[str, ...]

    def delta(self, changes: DataFrame) -> DataFrame:
        """The state rows that the changes add up to: keys, measure, value, n_rows and one column per sum."""
        sign = F.col("sign")
        columns = [F.col(c).alias(f"sum_{c}") for c in self.sums] + [F.col(c).alias(f"of_{c}") for c in self.extremes]
        row = changes.select(*self.keys, "sign", *columns)
        no_value = F.lit(None).cast("long")
        entries = [F.struct(F.lit(TOTALS).alias("measure"), no_value.alias("value"))]
        entries += [F.struct(F.lit(n).alias("measure"), F.col(f"of_{n}").cast("long").alias("value")) for n in self.extremes]
        listed = row.withColumn("entry", F.explode(F.array(*entries)))
        listed = listed.where((F.col("entry.measure") == TOTALS) | F.col("entry.value").isNotNull())
        total = lambda n: F.sum(F.when(F.col("entry.measure") == TOTALS, sign * F.col(f"sum_{n}"))).alias(n)
        return listed.groupBy(*self.keys, F.col("entry.measure").alias("measure"), F.col("entry.value").alias("value")).agg(
            F.sum(sign).cast("long").alias("n_rows"), *[F.coalesce(total(n), F.lit(0)).cast("long").alias(n) for n in self.sums]
        )

    def merged(self, *states: DataFrame) -> DataFrame:
        """The sum of the states; groups and values of which nothing is left go."""
        both = states[0]
        for state in states[1:]:
            both = both.unionByName(state)
        added = both.groupBy(*self.keys, "measure", "value").agg(*[F.sum(c).cast("long").alias(c) for c in ("n_rows", *self.sums)])
        return added.where(F.col("n_rows") != 0)

    def read(self, state: DataFrame) -> DataFrame:
        """keys, n_rows, the sums, and least_ and most_ of each extreme."""
        is_total = F.col("measure") == TOTALS
        of = lambda n: F.when((F.col("measure") == n) & (F.col("n_rows") > 0), F.col("value"))
        extremes = [pick(of(n)).alias(f"{name}_{n}") for n in self.extremes for name, pick in (("least", F.min), ("most", F.max))]
        sums = [F.sum(F.when(is_total, F.col(c))).cast("long").alias(c) for c in ("n_rows", *self.sums)]
        return state.groupBy(*self.keys).agg(*sums, *extremes)


def apply_changes(spark: SparkSession, path: str, summary: Summary, changes: DataFrame, batch: int) -> None:
    """Adds a batch of changes to the state at `path`; numbers of batches grow. A replay changes nothing."""
    partition = summary.keys[0]
    with scratch_scope(spark):
        delta = materialise(summary.delta(changes), "summary-delta")
        state = read_if_written(spark, path)
        if state is None:
            new = summary.merged(delta)
        else:
            state = state.join(delta.select(partition).distinct(), partition, "left_semi")
            known = state.groupBy(F.col(partition).alias("known")).agg(F.max("applied").alias("last"))
            open_delta = delta.join(known, F.col(partition) == F.col("known"), "left").where(
                F.col("last").isNull() | (F.col("last") < batch)
            )
            open_delta = open_delta.drop("known", "last")
            state = state.join(open_delta.select(partition).distinct(), partition, "left_semi")
            kept = [c for c in delta.columns]
            new = summary.merged(state.select(*kept), open_delta)
            # A partition that has become empty keeps a row, which says what was applied to it.
            emptied = open_delta.select(partition).distinct().join(new.select(partition).distinct(), partition, "left_anti")
            blank = {c: F.lit(None).cast(delta.schema[c].dataType) for c in summary.keys[1:]}
            zero = {c: F.lit(0).cast("long") for c in ("n_rows", *summary.sums)}
            emptied = emptied.withColumns({**blank, "measure": F.lit("-"), "value": F.lit(None).cast("long"), **zero})
            new = new.unionByName(emptied.select(*new.columns))
        (
            new.withColumn("applied", F.lit(batch).cast("long"))
            .hint("rebalance", F.col(partition))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition)
            .parquet(path)
        )


def read_summary(spark: SparkSession, path: str, summary: Summary) -> DataFrame:
    """The summary at `path` without groups that are empty."""
    state = spark.read.parquet(path)
    return summary.read(state.where(F.col("measure") != "-"))
