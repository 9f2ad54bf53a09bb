"""Exact money, rates and averages.

Prices are doubles with two decimals. Summing doubles depends on row order, so money is summed as whole
cents in 64-bit integers and every quotient is rounded half up in decimal arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_cents(amount: Column) -> Column:
    return F.floor(amount * F.lit(100.0) + F.lit(0.5))


def from_cents(cents: Column) -> Column:
    return cents.cast("double") / F.lit(100.0)


def ratio(numerator: Column, denominator: Column, scale: int) -> Column:
    """`numerator / denominator` rounded half up; null when the denominator is 0 or null."""
    quotient = F.try_divide(numerator.cast("decimal(24,4)"), denominator.cast("decimal(18,0)"))
    return F.round(quotient, scale).cast("double")


def exact_mean(cents: Column, count: Column) -> Column:
    """Unrounded average amount. One division, so that the result is the double closest to the average."""
    return cents.cast("double") / (count * 100).cast("double")


def mean_cents(cents: Column, count: Column) -> Column:
    """Average amount rounded to cents."""
    return ratio(cents, count * 100, 2)


def percent(part: Column, whole: Column, scale: int = 2) -> Column:
    """Share in percent, null without a denominator."""
    return ratio(part * 100, whole, scale)


def conversion_rate(part: Column, whole: Column, scale: int = 4) -> Column:
    """Share in percent, 0 without a positive denominator."""
    return F.when(whole > 0, percent(part, whole, scale)).otherwise(F.lit(0.0))


def cents_to_dollars(cents: Column, scale: int = 2) -> Column:
    return ratio(cents, F.lit(100), scale)


# Units of the readable quantity format, largest first.
QUANTITY_UNITS = [
    (10**15, "quadrillion"),
    (10**12, "trillion"),
    (10**9, "billion"),
    (10**6, "million"),
    (10**3, "thousand"),
]


def readable_quantity(amount: Column) -> Column:
    """`1234567` as `1.23 million`."""
    exact = amount.cast("decimal(24,2)")

    def scaled(size: int) -> Column:
        return F.round(exact / F.lit(size).cast("decimal(18,0)"), 2).cast("decimal(24,2)").cast("string")

    text = scaled(1)
    for size, unit in reversed(QUANTITY_UNITS):
        text = F.when(F.abs(exact) >= size, F.concat(scaled(size), F.lit(f" {unit}"))).otherwise(text)
    return text
