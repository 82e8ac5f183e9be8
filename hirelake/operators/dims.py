"""Dimension tables and the calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake import schemas
from hirelake.functions.dates import calendar_columns
from hirelake.operators.keyed import one_per_key


def dimension(clean: DataFrame, key: str, pk: str, labels: Sequence[str]) -> DataFrame:
    """One row per key. Where short keys collide the smallest label stays; NULL keys have no row.

    The distinct pairs come first: that step aggregates by hash before its shuffle, so a label that
    holds a third of all rows arrives as one row per partition. Of what is left one row per key stays;
    the sort for that sees distinct pairs only.
    """
    pairs = clean.select(F.col(key).alias(pk), *labels).where(F.col(pk).isNotNull()).distinct()
    return one_per_key(pairs, [pk], [F.asc(label) for label in labels])


def merged_dimension(stored: DataFrame, incoming: DataFrame, pk: str) -> DataFrame:
    """Both dimensions in one: where they give a key different labels the smallest stays.

    So the result doesn't depend on how adverts were split into batches.
    """
    labels = [c for c in stored.columns if c != pk]
    both = stored.unionByName(incoming.select(*stored.columns)).distinct()
    return one_per_key(both, [pk], [F.asc(label) for label in labels])


def role_dim(clean: DataFrame) -> DataFrame:
    return dimension(clean, "role_key", "role_pk", ["role"])


def employment_type_dim(clean: DataFrame) -> DataFrame:
    return dimension(clean, "employment_type_key", "employment_type_pk", ["employment_type"])


def company_dim(clean: DataFrame) -> DataFrame:
    return dimension(clean, "company_key", "company_pk", ["company"])


def location_dim(clean: DataFrame) -> DataFrame:
    """Keys come from the raw location text, so one country and city may have several."""
    return dimension(clean, "location_key", "location_pk", ["country", "city"])


def calendar_over(bounds: DataFrame, first: Column | str, last: Column | str) -> DataFrame:
    """The days from first to last, both included, of a one-row table of bounds."""
    days = bounds.select(F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY"))).alias("day"))
    return days.select(*calendar_columns(F.col("day")))


def date_dim(
    spark: SparkSession, first: str = schemas.CALENDAR_START, last: str = schemas.CALENDAR_END
) -> DataFrame:
    """The calendar dimension between two dates."""
    bounds = spark.range(1).select(
        F.lit(first).cast("date").alias("first"), F.lit(last).cast("date").alias("last")
    )
    return calendar_over(bounds, "first", "last")
