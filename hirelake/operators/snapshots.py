"""Daily counts kept by what an upsert changes, without counting the whole fact again.

A row that an upsert replaces counts -1 on its old day and +1 on its new one. Changes of a batch are few
rows, one per day, so the counts follow a fact of any size at the cost of the batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hirelake.operators import versions
from hirelake.operators.keyed import one_per_key, with_whole_key
from hirelake.session import delete_path, scratch_path

DAY, COUNT = "snap_date", "open_ads"
_NEW, _RANK = "_new", "_rank"


def _stored(df: DataFrame, path: str) -> DataFrame:
    """The rows, written and read back."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def affected_rows(stored: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The stored rows whose key is in the batch. The batch's keys are the small side of a semi join."""
    return stored.join(incoming.select(*keys).distinct(), list(keys), "left_semi").select(*stored.columns)


def count_changes(before: DataFrame, after: DataFrame, day: str) -> DataFrame:
    """(snap_date, open_ads): by how much the number of rows of a day changes; days without a change are left out."""
    signed = before.select(F.col(day).cast("date").alias(DAY), F.lit(-1).cast("long").alias(COUNT)).unionByName(
        after.select(F.col(day).cast("date").alias(DAY), F.lit(1).cast("long").alias(COUNT))
    )
    return signed.groupBy(DAY).agg(F.sum(COUNT).alias(COUNT)).where(F.col(COUNT) != 0)


def changed_counts(counts: DataFrame, changes: DataFrame) -> DataFrame:
    """The counts after the changes; a day whose last row is gone has no count."""
    both = counts.select(DAY, COUNT).unionByName(changes.select(DAY, COUNT))
    return both.groupBy(DAY).agg(F.sum(COUNT).alias(COUNT)).where(F.col(COUNT) != 0)


def upsert_counted(
    spark: SparkSession,
    fact_path: str,
    counts_path: str,
    incoming: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    day: str,
) -> None:
    """Merges a batch into a versioned fact, where the first row in ``order`` wins, and its daily counts with it.

    ``order`` has to tell the rows of a key apart; then batches may come in any order, and once more. Both
    tables are written before either shows the batch. If the job is lost between the two, the next call
    sees from the version numbers that the counts are behind and counts the fact anew.
    """
    base = versions.current_version(spark, fact_path)
    behind = versions.current_version(spark, counts_path) != base
    # The batch and the rows that it touches are used several times: they are made once and stored.
    staged = scratch_path(spark, "upsert")
    batch = _stored(one_per_key(with_whole_key(incoming, keys), keys, order), f"{staged}/batch")
    stored = versions.read_version(spark, fact_path, base) if base else spark.createDataFrame([], batch.schema)
    old = affected_rows(stored, batch, keys)
    # Of a stored and a new row the first one wins; a key that is new has no other row.
    both = old.withColumn(_NEW, F.lit(False)).unionByName(batch.select(*stored.columns).withColumn(_NEW, F.lit(True)))
    ranked = both.withColumn(_RANK, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    touched = _stored(ranked.where((F.col(_RANK) == 1) | ~F.col(_NEW)), f"{staged}/touched")
    before, after = touched.where(~F.col(_NEW)), touched.where(F.col(_RANK) == 1).select(*stored.columns)
    rest = stored.join(batch.select(*keys), list(keys), "left_anti").select(*stored.columns)
    changes = count_changes(before, after, day)
    if behind or not base:
        counted = count_changes(stored.limit(0), stored, day)
    else:
        counted = versions.read_version(spark, counts_path, base)
    # Counts have the version number of the fact they count; the fact comes first.
    tables = {fact_path: rest.unionByName(after), counts_path: changed_counts(counted, changes)}
    versions.publish_all(spark, tables, {fact_path: base, counts_path: base})
    delete_path(spark, staged)
