"""Bounded training samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEPS = 1 << 30


def hash_sample(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """All rows of a table of at most `rows` rows, else about `rows` of them, chosen by a hash of `keys`.

    Reruns choose the same rows. Rows with equal keys are chosen together.
    """
    total = df.count()
    if total <= rows:
        return df
    place = F.xxhash64(F.lit("sample"), *[F.col(k) for k in keys]).bitwiseAND(F.lit(STEPS - 1))
    return df.where(place < F.lit(int(rows / total * STEPS)))


def hash_sample_by(df: DataFrame, group: str, totals: dict[str, int], rows: int, *keys: str) -> DataFrame:
    """Of each group in `totals` (its number of rows) all rows if they are at most `rows`, else about `rows` of them.

    As in `hash_sample` a hash of `keys` decides. Rows of other groups are left out.
    """
    limits = F.create_map(*[F.lit(x) for name, n in totals.items() for x in (name, STEPS if n <= rows else int(rows / n * STEPS))])
    place = F.xxhash64(F.lit("sample"), *[F.col(k) for k in keys]).bitwiseAND(F.lit(STEPS - 1))
    return df.where(place < limits[F.col(group)])
