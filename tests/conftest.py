import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hirelake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows of literal tuples as a DataFrame."""

    def make(schema, *values):
        return spark.createDataFrame(list(values), schema)

    return make


@pytest.fixture
def value(spark):
    """The value of one expression over one row of columns."""

    def evaluate(expression, schema="x string", *cells):
        return spark.createDataFrame([tuple(cells)], schema).select(expression.alias("v")).first()["v"]

    return evaluate
