"""The factless fact table and the snapshot of open adverts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake import schemas
from hirelake.operators.keyed import one_per_key, with_whole_key


def newest_first() -> list[Column]:
    """The order that puts the newest of several adverts with one fact key first."""
    return [F.desc("last_updated"), F.desc("id")]


def fact_candidates(
    adverts: DataFrame,
    roles: DataFrame,
    companies: DataFrame,
    types: DataFrame,
    locations: DataFrame,
) -> DataFrame:
    """Adverts whose four keys all stand in their dimension, with their id.

    Only the keys of the dimensions are joined. Sides below the session's broadcast threshold, known
    from their files or measured while the query runs, don't shuffle the adverts; a key that holds a
    third of all adverts is split where they are.
    """
    joined = adverts
    for dim, name in (
        (roles, "role"),
        (companies, "company"),
        (types, "employment_type"),
        (locations, "location"),
    ):
        joined = joined.join(dim.select(F.col(f"{name}_pk").alias(f"{name}_key")), f"{name}_key")
    return batch_candidates(joined)


def batch_candidates(adverts: DataFrame) -> DataFrame:
    """Adverts with keys in the columns of the fact, with their id and the days between post and update.

    This is all that is left of the four joins for adverts whose dimensions are loaded from these
    same adverts: a key then stands in its dimension unless it is NULL, and ``fact_rows`` drops NULLs.
    """
    keyed = adverts.select(
        "id",
        F.col("date_posted").alias("date_posted_fk"),
        F.col("role_key").alias("role_fk"),
        F.col("company_key").alias("company_fk"),
        F.col("employment_type_key").alias("employment_type_fk"),
        F.col("location_key").alias("location_fk"),
        "toolset_list",
        F.col("metadata_lastupdated").alias("last_updated"),
    )
    return with_days_opened(keyed, "date_posted_fk", "last_updated")


def fact_rows(candidates: DataFrame) -> DataFrame:
    """One fact per key: the newest advert."""
    keys = schemas.FACT.key
    return schemas.conform(
        one_per_key(with_whole_key(candidates, keys), keys, newest_first()), schemas.FACT
    )


def daily_snapshot(fact: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """How many facts were last updated on a day (today by default). Always one row."""
    day = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    counted = fact.where(F.col("last_updated").cast("date") == day).agg(F.count(F.lit(1)).alias("open_ads"))
    return counted.select(day.alias("snap_date"), "open_ads")


def snapshot_history(fact: DataFrame) -> DataFrame:
    """The snapshot of every day on which facts were last updated."""
    return fact.groupBy(F.col("last_updated").cast("date").alias("snap_date")).agg(
        F.count(F.lit(1)).alias("open_ads")
    )


def with_days_opened(adverts: DataFrame, first: str, last: str) -> DataFrame:
    """Days between the posting date and the last update; NULL without one of them."""
    return adverts.withColumn("days_opened", F.date_diff(F.col(last).cast("date"), F.col(first).cast("date")))


def lookup_update(target: DataFrame, column: str, dim: DataFrame, pk: str, label: str) -> DataFrame:
    """Set ``column`` to the key the dimension has for the row's label; keep it without one.

    A label with several keys takes the smallest, so no row is doubled. For dimensions of a few labels,
    such as the roles, of which there are as many as rules: they are broadcast, and the rows stay where
    they are.
    """
    keys = dim.groupBy(label).agg(F.min(pk).alias("_found"))
    return target.join(F.broadcast(keys), label, "left").select(
        *[
            F.coalesce("_found", column).alias(column) if name == column else F.col(name)
            for name in target.columns
        ]
    )
