"""The three ways to keep a model: as a view, as a table, and as an incrementally merged table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartwright.operators.merge import merge_into, new_rows
from cartwright.session import read_if_written
from cartwright.sources.files import write_table


def as_view(spark: SparkSession, query: str, name: str) -> None:
    """A catalog view over tables, replaced on each run."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")


def as_table(df: DataFrame, name: str, path: str, *partition_by: str) -> None:
    write_table(df, name, path, *partition_by)


def as_incremental(
    spark: SparkSession,
    source: DataFrame,
    model: Callable[[DataFrame], DataFrame],
    path: str,
    key: str,
    mark: str,
    partition: str,
) -> None:
    """Runs `model` over the source rows above the table's high-water mark and merges them by `key`.

    The first run takes all rows.
    """
    table = read_if_written(spark, path)
    if table is not None:
        source = new_rows(source, table, mark)
    merge_into(spark, path, model(source), [key], [mark], partition)
