"""Every registered query against its SQL equivalent, over whole tables."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from hirelake.plans.oracle import ORACLE_SQL
from hirelake.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "decimal(18,7)": "DECIMAL(18,7)",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET timezone = 'UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLE_SQL) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    found = QUERIES[name](spark, FOLDER)
    expected = duck.execute(ORACLE_SQL[name])
    types = {c[0]: str(c[1]) for c in expected.description}
    assert {c: TYPES[t] for c, t in found.dtypes} == types
    order = sorted(types)
    positions = [list(types).index(c) for c in order]
    wanted = sorted(tuple(str(r[i]) for i in positions) for r in expected.fetchall())
    assert sorted(tuple(str(r[c]) for c in order) for r in found.collect()) == wanted
    assert wanted


def test_entry(spark):
    result = entry_module.entry(spark)
    assert result.columns[:2] == ["role", "country"]
    assert result.count() > 0


def test_classifier_beats_the_largest_class(spark):
    found = QUERIES["train_text_classifier"](spark, FOLDER).collect()
    right = sum(r["lang"] == r["predicted"] for r in found)
    largest = max(sum(r["lang"] == lang for r in found) for lang in ("en", "de", "fr", "es"))
    assert right > largest and right / len(found) > 0.8
