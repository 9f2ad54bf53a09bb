"""Cleaning rules and derived columns of one commerce event, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartwright.functions.money import from_cents, to_cents

# Event types, default labels and price-tier limits.
EVENT_TYPES = ["view", "cart", "purchase", "remove_from_cart"]
UNKNOWN_BRAND = "Unknown"
NO_CATEGORY = "uncategorized"
NO_SUBCATEGORY = "general"
PRICE_TIERS = [(10, "budget"), (50, "mid-range"), (200, "premium")]
RAW_PRICE_TIERS = [(10, "budget"), (50, "mid_range"), (200, "premium")]
FREE_TIER = "free"
TOP_TIER = "luxury"
KEY_SEPARATOR = "|"
KEY_NULL = "_NULL_"


def _text_or(column: Column, default: str) -> Column:
    return F.coalesce(F.nullif(F.trim(column), F.lit("")), F.lit(default))


def clean_brand(brand: Column) -> Column:
    return _text_or(brand, UNKNOWN_BRAND)


def clean_category(category_code: Column) -> Column:
    return _text_or(category_code, NO_CATEGORY)


def clean_price(price: Column) -> Column:
    return F.when(price >= 0, price).otherwise(F.lit(0.0))


def clean_price_rounded(price: Column) -> Column:
    return from_cents(to_cents(clean_price(price)))


def normalised_brand(brand: Column) -> Column:
    return F.lower(F.trim(clean_brand(brand)))


def category_levels(category: Column) -> dict[str, Column]:
    """The dotted path of a cleaned category; absent levels are `general` and null."""
    parts = F.split(category, r"\.")
    return {
        "category_level1": F.get(parts, F.lit(0)),
        "category_level2": F.coalesce(F.get(parts, F.lit(1)), F.lit(NO_SUBCATEGORY)),
        "category_level3": F.get(parts, F.lit(2)),
    }


def _tier(price: Column, limits: list[tuple[int, str]], is_free: Column) -> Column:
    tier = F.when(is_free, FREE_TIER)
    for limit, label in limits:
        tier = tier.when(price < limit, label)
    return tier.otherwise(TOP_TIER)


def price_tier(repaired_price: Column) -> Column:
    return _tier(repaired_price, PRICE_TIERS, repaired_price == 0)


def price_tier_raw(price: Column) -> Column:
    """Tier of the unrepaired price: null is free, a negative price is budget."""
    return _tier(price, RAW_PRICE_TIERS, price.isNull() | (price == 0))


def is_weekend(date: Column) -> Column:
    return F.dayofweek(date).isin(1, 7)


def is_weekend_compat(date: Column) -> Column:
    """The job variant, which tests the day of the month instead of the weekday."""
    return F.dayofmonth(date).isin(0, 6)


def day_of_week_compat(date: Column) -> Column:
    """The job variant: day of the month modulo 7."""
    return F.dayofmonth(date) % 7


def date_parts(date: Column, prefix: str) -> dict[str, Column]:
    return {
        f"{prefix}_year": F.year(date),
        f"{prefix}_month": F.month(date),
        f"{prefix}_day": F.dayofmonth(date),
        f"{prefix}_quarter": F.quarter(date),
        f"{prefix}_week": F.weekofyear(date),
        f"{prefix}_day_of_week": F.dayofweek(date),
    }


def week_start(date: Column) -> Column:
    """The Sunday on or before `date`."""
    return F.date_sub(date, F.dayofweek(date) - 1)


def session_bucket(user_id: Column, event_time: Column) -> Column:
    """User, day and four-hour bucket."""
    day = F.year(event_time) * 10_000 + F.month(event_time) * 100 + F.dayofmonth(event_time)
    return F.concat_ws("_", user_id, day, F.floor(F.hour(event_time) / F.lit(4)))


def surrogate_key(*columns: Column) -> Column:
    """MD5 over the joined text of the columns."""
    texts = [F.coalesce(c.cast("string"), F.lit(KEY_NULL)) for c in columns]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *texts))


def date_range(date: Column, first: str, last: str) -> Column:
    """Both ends included."""
    return date.between(F.to_date(F.lit(first)), F.to_date(F.lit(last)))


def draw(name: str, key: Column, modulus: int) -> Column:
    """A repeatable draw from 0..modulus-1 per key; draws with different names are independent.

    It stands in for a random number so that a retried task produces the same row again.
    """
    digest = F.md5(F.concat_ws("|", F.lit(name), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % modulus
