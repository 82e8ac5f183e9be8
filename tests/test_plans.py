"""Physical plans: what is pushed down, limited before the shuffle, broadcast or pruned."""

import re

import pytest
from pyspark.sql import functions as F

from hirelake import schemas
from hirelake.operators import dims, enrich, facts, keyed
from hirelake.plans import queries
from hirelake.session import scratch_path
from hirelake.sources import fixtures

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_no_query_crosses_rows_or_runs_python(spark, name):
    text = plan(queries.QUERIES[name](spark, FOLDER))
    for step in ("CartesianProduct", "NestedLoop", "EvalPython", "MapInPandas", "PythonUDF"):
        assert step not in text


def test_winners_are_limited_before_the_shuffle(spark):
    adverts = fixtures.postings(spark, FOLDER)
    text = plan(keyed.first_wins(adverts, schemas.RAW_JOBS.key, "id"))
    final, exchange, partial = (
        text.index(s) for s in ("WindowGroupLimit", "Exchange hashpartitioning(title", "1, Partial")
    )
    assert final < exchange < partial


def test_enrichment_adds_no_shuffle(spark):
    raw = spark.read.schema(schemas.RAW_JOBS.columns).parquet(written(spark))
    assert "Exchange" not in plan(enrich.keyed_postings(raw))
    placed = plan(enrich.clean_postings(raw, fixtures.gazetteer(spark, FOLDER)))
    top = placed.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in top and "Exchange hashpartitioning" not in top


def written(spark):
    path = scratch_path(spark, "raw")
    schemas.conform(fixtures.postings(spark, FOLDER), schemas.RAW_JOBS).write.parquet(path)
    return path


def test_snapshot_of_a_stored_fact_pushes_the_day_down(spark):
    path = scratch_path(spark, "fact")
    fact = queries.batch_fact(spark, FOLDER)
    fact.withColumn("posted_month", F.date_format("date_posted_fk", "yyyy-MM")).write.partitionBy(
        "posted_month"
    ).parquet(path)
    text = plan(facts.daily_snapshot(spark.read.parquet(path), "1998-08-02"))
    assert "GreaterThanOrEqual(last_updated,1998-08-02T00:00)" in text
    assert re.search(r"ReadSchema: struct<last_updated:timestamp_ntz>", text)


def test_dimension_scan_reads_its_columns_only(spark):
    clean = spark.read.parquet(stored_clean(spark))
    assert "ReadSchema: struct<role_key:string,role:string>" in plan(dims.role_dim(clean))


def stored_clean(spark):
    path = scratch_path(spark, "clean")
    queries.clean(spark, FOLDER).write.parquet(path)
    return path


def test_small_batch_leaves_the_stored_table_unshuffled(spark):
    path = scratch_path(spark, "fact")
    queries.batch_fact(spark, FOLDER).write.parquet(path)
    target = spark.read.parquet(path)
    batch_path = scratch_path(spark, "batch")
    target.limit(10).write.parquet(batch_path)
    text = plan(keyed.upsert(target, spark.read.parquet(batch_path), schemas.FACT.key))
    assert "LeftAnti, BuildRight" in text and "hashpartitioning" not in text


def test_dimensions_reduce_by_hash_before_they_shuffle(spark):
    text = plan(dims.company_dim(spark.read.parquet(stored_clean(spark))))
    assert "SortAggregate" not in text
    below = text[text.index("Exchange hashpartitioning") :]
    assert "HashAggregate" in text and "HashAggregate" in below


def test_lookup_update_and_rejoined_pieces_move_no_row(spark):
    adverts = spark.read.parquet(stored_clean(spark))
    blank = adverts.select("id", "role", F.lit(None).cast("string").alias("role_key"))
    text = plan(facts.lookup_update(blank, "role_key", dims.role_dim(adverts), "role_pk", "role"))
    assert "BroadcastHashJoin" in text and "Exchange" not in text.split("BroadcastExchange")[0]
    assert "Exchange" not in plan(queries.QUERIES["rejoin_chunks"](spark, FOLDER))
