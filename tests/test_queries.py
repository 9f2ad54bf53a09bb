"""Every registered query against its SQL, value by value and type by type."""

import pytest

import __spark_entry__ as entry_points
from cartwright.plans import oracles, queries

SMALL = "/root/testdata/sf0.001"
QUERIES = queries.queries()
ORACLES = oracles.oracle_sql()
SQL_TYPES = {
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}

# Rows of the mapped tables at the smallest scale.
EXPECTED_ROWS = {
    "bronze_partition_cols": 1091,
    "events_cleaned": 980,
    "daily_sales": 178,
    "funnel_daily": 90,
    "customer_rfm": 15,
    "product_performance": 147,
    "stg_products": 100,
    "hourly_traffic": 966,
    "wow_growth": 13,
}


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_points_offer_every_query():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    listed = ", ".join(f'"{c}"' for c in columns)
    result = duck.execute(f"SELECT {listed} FROM ({ORACLES[name]})")
    types = [str(d[1]) for d in result.description]
    expected = result.fetchall()
    assert [SQL_TYPES[df.schema[c].dataType.simpleString()] for c in columns] == types
    assert ordered(df.select(*columns).collect()) == ordered(expected)
    if name in EXPECTED_ROWS:
        assert len(expected) == EXPECTED_ROWS[name]


def test_entry_is_the_daily_funnel(spark):
    assert entry_points.entry(spark).count() == 90


def test_zero_denominators_occur(spark):
    funnel = QUERIES["funnel_daily"](spark, SMALL)
    assert funnel.where("views = 0").count() == 4
    assert funnel.where("carts = 0").count() == 8
    assert funnel.where("views = 0 AND overall_conversion_rate IS NULL").count() == 4
    assert funnel.where("carts = 0 AND cart_to_purchase_rate = 0").count() == 8
