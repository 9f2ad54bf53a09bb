"""Cleaning rules, money and segments on hand-written rows."""

from collections import Counter
from decimal import ROUND_HALF_UP, Decimal
from itertools import product

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartwright.functions import events as ev
from cartwright.functions import money
from cartwright.functions import segments as sg
from cartwright.plans import gold


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"n int, v {kind}")
    return [r[0] for r in df.orderBy("n").select(expression(F.col("v"))).collect()]


def test_text_defaults(spark):
    values = [None, "", "   ", " Acme ", "acme"]
    assert column(spark, values, "string", ev.clean_brand) == ["Unknown"] * 3 + ["Acme", "acme"]
    assert column(spark, values, "string", ev.normalised_brand) == ["unknown"] * 3 + ["acme", "acme"]
    assert column(spark, values, "string", ev.clean_category)[:3] == ["uncategorized"] * 3


def test_category_levels(spark):
    values = ["a", "a.b", "a.b.c", "a.b.c.d"]
    levels = lambda c: F.struct(*[v.alias(n) for n, v in ev.category_levels(c).items()])
    assert [tuple(r) for r in column(spark, values, "string", levels)] == [
        ("a", "general", None),
        ("a", "b", None),
        ("a", "b", "c"),
        ("a", "b", "c"),
    ]


def test_prices_and_tiers(spark):
    values = [None, -3.0, 0.0, 9.99, 10.0, 49.99, 50.0, 199.99, 200.0]
    assert column(spark, values, "double", ev.clean_price)[:3] == [0.0, 0.0, 0.0]
    tiers = column(spark, values, "double", lambda c: ev.price_tier(ev.clean_price(c)))
    assert tiers == ["free"] * 3 + ["budget", "mid-range", "mid-range", "premium", "premium", "luxury"]
    raw = column(spark, values, "double", ev.price_tier_raw)
    assert raw == ["free", "budget", "free", "budget", "mid_range", "mid_range", "premium", "premium", "luxury"]


def test_weekend_variants(spark):
    days = ["2024-01-05", "2024-01-06", "2024-01-07", "2024-01-08"]
    assert column(spark, days, "string", lambda c: ev.is_weekend(F.to_date(c))) == [False, True, True, False]
    assert column(spark, days, "string", lambda c: ev.is_weekend_compat(F.to_date(c))) == [False, True, False, False]


def test_week_starts_on_sunday(spark):
    days = ["2024-01-06", "2024-01-07", "2024-01-13"]
    starts = column(spark, days, "string", lambda c: ev.week_start(F.to_date(c)))
    assert [str(d) for d in starts] == ["2023-12-31", "2024-01-07", "2024-01-07"]


def test_surrogate_key_separates_null_and_text(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), (None, "a")], "x string, y string")
    keys = [r[0] for r in df.select(ev.surrogate_key(F.col("x"), F.col("y"))).collect()]
    assert len(set(keys)) == 3 and all(len(k) == 32 for k in keys)


def test_readable_quantity(spark):
    values = [0, 12, 999, 1000, 1024, 1234567, 4567000000, 5 * 10**12, 2 * 10**15]
    assert column(spark, values, "long", money.readable_quantity) == [
        "0.00",
        "12.00",
        "999.00",
        "1.00 thousand",
        "1.02 thousand",
        "1.23 million",
        "4.57 billion",
        "5.00 trillion",
        "2.00 quadrillion",
    ]


def test_conversion_rates(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (0, 4), (5, None)], "n long, d long")
    n, d = F.col("n"), F.col("d")
    got = [tuple(r) for r in df.select(money.conversion_rate(n, d), money.percent(n, d)).collect()]
    assert got == [(33.3333, 33.33), (0.0, None), (0.0, 0.0), (0.0, None)]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 10**9), st.integers(1, 10**6)), min_size=1, max_size=30))
def test_mean_rounds_half_up(spark, pairs):
    df = spark.createDataFrame([(i, c, n) for i, (c, n) in enumerate(pairs)], "i int, c long, n long")
    got = [r[0] for r in df.orderBy("i").select(money.mean_cents(F.col("c"), F.col("n"))).collect()]
    exact = [(Decimal(c) / n / 100).quantize(Decimal("0.01"), ROUND_HALF_UP) for c, n in pairs]
    assert got == [float(e) for e in exact]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 10**12), min_size=1, max_size=30))
def test_cents_are_exact(spark, cents):
    assert column(spark, [c / 100 for c in cents], "double", money.to_cents) == cents


# Published days: date, six counts, revenue in cents, and the six rates they must give.
GOLDEN = [
    ("2019-12-01", 59526, 33934, 7230, 16662, 4164, 825, 3268673, 57.01, 21.31, 12.146, 24.99, 19.81, 39.62),
    ("2019-12-02", 64918, 35534, 9072, 18434, 4618, 1014, 4327100, 54.74, 25.53, 13.9746, 25.05, 21.96, 42.67),
    ("2019-12-03", 63500, 38348, 8212, 17888, 4449, 981, 3868224, 60.39, 21.41, 12.9323, 24.87, 22.05, 39.43),
    ("2019-11-28", 95785, 65516, 16971, 22071, 7597, 1897, 7746323, 68.4, 25.9, 17.7178, 34.42, 24.97, 40.83),
    ("2019-10-31", 57478, 33070, 8028, 15350, 4183, 934, 3970541, 57.54, 24.28, 13.9671, 27.25, 22.33, 42.51),
]


def test_published_funnel_days(spark):
    counts = spark.createDataFrame(
        [day[:8] for day in GOLDEN],
        "event_date string, views long, carts long, purchases long, unique_viewers long, unique_carters long, "
        "unique_purchasers long, cents long",
    ).withColumn("event_date", F.to_date("event_date"))
    rates = gold.funnel_rates(counts).select(
        F.col("event_date").cast("string"),
        "view_to_cart_rate",
        "cart_to_purchase_rate",
        "overall_conversion_rate",
        "user_view_to_cart_rate",
        "user_cart_to_purchase_rate",
        "avg_revenue_per_purchaser",
    )
    assert {tuple(r) for r in rates.collect()} == {(day[0], *day[8:]) for day in GOLDEN}


def test_every_score_triple(spark):
    triples = list(product(range(1, 6), repeat=3))
    df = spark.createDataFrame(triples, "r int, f int, m int")
    scores = (F.col("r"), F.col("f"), F.col("m"))
    rows = df.select("r", "f", "m", sg.segment_8(*scores), sg.segment_12(*scores), sg.segment_6(*scores)).collect()
    eight, twelve, six = (Counter(r[i] for r in rows) for i in (3, 4, 5))
    assert sum(eight.values()) == sum(twelve.values()) == sum(six.values()) == 125
    others = {(r.r, r.f) for r in rows if r[3] == "Others"}
    assert eight["Others"] == 20 and others == {(1, 3), (2, 3), (3, 1), (3, 2)}
    # Earlier rules take all the cases of these two.
    assert "Hibernating" not in twelve and "Lost" not in twelve
    assert set(six) == {"Champions", "Loyal Customers", "New Customers", "At Risk", "Lost", "Others"}


@pytest.mark.parametrize("rate, band", [(5.0, "Excellent"), (4.99, "Good"), (1.0, "Average"), (0.99, "Needs Improvement"), (None, "Needs Improvement")])
def test_funnel_health(spark, rate, band):
    assert column(spark, [rate], "double", sg.funnel_health) == [band]


def test_actions(spark):
    got = column(spark, ["Champions", "Loyal Customers", "Potential Loyalists", "About to Sleep"], "string", sg.action_recommendation)
    assert got == ["VIP - Priority support", "High Value - Retention focus", "Standard", "Win Back - Re-engagement"]
