"""The scalar rules as temporary SQL functions, for use in `spark.sql`."""

from __future__ import annotations

from pyspark.sql import SparkSession

from cartwright.functions.events import KEY_NULL, KEY_SEPARATOR
from cartwright.functions.segments import SEGMENTS_6, SEGMENTS_6_DEFAULT


def _quotient(numerator: str, denominator: str, scale: int) -> str:
    return (
        f"CAST(ROUND(TRY_DIVIDE(CAST({numerator} AS DECIMAL(24,4)), CAST({denominator} AS DECIMAL(18,0))), {scale}) AS DOUBLE)"
    )


def _segment_cases() -> str:
    branches = " ".join(
        f"WHEN r BETWEEN {r[0]} AND {r[1]} AND f BETWEEN {f[0]} AND {f[1]} AND m BETWEEN {m[0]} AND {m[1]} THEN '{label}'"
        for label, r, f, m in SEGMENTS_6
    )
    return f"CASE {branches} ELSE '{SEGMENTS_6_DEFAULT}' END"


def register_sql_functions(spark: SparkSession) -> None:
    rate = _quotient("part * 100", "whole", 4)
    definitions = {
        "surrogate_key(parts ARRAY<STRING>) RETURNS STRING": (
            f"MD5(ARRAY_JOIN(parts, '{KEY_SEPARATOR}', '{KEY_NULL}'))"
        ),
        "in_date_range(day DATE, first DATE, last DATE) RETURNS BOOLEAN": "day BETWEEN first AND last",
        "cents_to_dollars(cents BIGINT) RETURNS DOUBLE": _quotient("cents", "100", 2),
        "conversion_rate(part BIGINT, whole BIGINT) RETURNS DOUBLE": f"CASE WHEN whole > 0 THEN {rate} ELSE 0D END",
        "conversion_rate_or_null(part BIGINT, whole BIGINT) RETURNS DOUBLE": rate,
        "rfm_segment(r INT, f INT, m INT) RETURNS STRING": _segment_cases(),
    }
    for signature, body in definitions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
