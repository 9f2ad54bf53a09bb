import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from cartwright.plans.queries import inputs as query_inputs  # noqa: E402
from cartwright.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[*]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small(spark):
    """The inputs of the smallest tables."""
    return query_inputs(spark, SMALL)


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(SMALL):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{name}'")
    return connection


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def rows_of(df, *order):
    """Collected rows as tuples, sorted where nulls may occur."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))
