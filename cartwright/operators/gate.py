"""Batches that are judged while they are written.

The tests of a batch are counted by the job that writes it, so its rows are computed once. A batch is written to a folder of
its own and readers see it once it has passed. That a key is unique is a matter of the whole table: a table of the keys of
accepted batches is kept beside it, and the batch's keys are looked up there instead of in the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cartwright.session import materialise, read_if_written, scratch_scope


class Gate:
    """A table at `path` of accepted batches, and the tests that a batch has to pass."""

    def __init__(self, spark: SparkSession, path: str, key: str, not_null: list[str], accepted: dict[str, list[str]]):
        self.spark, self.key, self.not_null, self.accepted = spark, key, not_null, accepted
        self.rows, self.keys, self.report = f"{path}/rows", f"{path}/keys", f"{path}/report"

    def write(self, batch: DataFrame, number: int) -> bool:
        """Writes a batch with its report; whether it was accepted. A batch that is written again is judged again."""
        counts = {("rows", ""): F.count(F.lit(1))}
        counts |= {("not_null", c): F.count_if(F.col(c).isNull()) for c in self.not_null}
        counts |= {("accepted_values", c): F.count_if(~F.col(c).isin(values)) for c, values in self.accepted.items()}
        seen = Observation()
        observed = batch.observe(seen, *[n.cast("long").alias("|".join(test)) for test, n in counts.items()])
        folder = f"{self.rows}/batch={number}"
        observed.write.mode("overwrite").parquet(folder)
        failures = {tuple(name.split("|")): n for name, n in seen.get.items()}
        rows = failures.pop(("rows", ""))
        with scratch_scope(self.spark):
            # Of the written rows only the key is read again.
            written = self.spark.read.schema(batch.schema).parquet(folder).where(F.col(self.key).isNotNull())
            keys = materialise(written.groupBy(self.key).agg(F.count(F.lit(1)).alias("copies")), "batch-keys")
            twice = keys.where("copies > 1").select(self.key)
            known = read_if_written(self.spark, self.keys)
            if known is not None:
                earlier = known.where(F.col("batch") != number).select(self.key)
                twice = twice.unionByName(keys.select(self.key).join(earlier, self.key, "left_semi")).distinct()
            failures["unique", self.key] = twice.count()
            passed = not any(failures.values())
            if passed:
                keys.select(self.key).write.mode("overwrite").parquet(f"{self.keys}/batch={number}")
        report = [(test, column, n, rows) for (test, column), n in failures.items()]
        report = self.spark.createDataFrame(report, "test string, column_name string, failures long, row_count long")
        report.write.mode("overwrite").parquet(f"{self.report}/batch={number}")
        return passed

    def results(self) -> DataFrame:
        """batch, test, column_name, failures, row_count and passed of every batch."""
        return self.spark.read.parquet(self.report).withColumn("passed", F.col("failures") == 0)

    def read(self) -> DataFrame:
        """The rows of accepted batches; folders of others are not read."""
        failed = self.results().groupBy("batch").agg(F.min("passed").alias("accepted"))
        return self.spark.read.parquet(self.rows).join(failed.where("accepted").select("batch"), "batch", "left_semi")
