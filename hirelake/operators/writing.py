"""Writing tables as Parquet folders: reload and keyed upsert."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.operators import versions
from hirelake.operators.keyed import rank_by_id
from hirelake.session import delete_path, path_exists, rename_path

Merge = Callable[[DataFrame, DataFrame], DataFrame]


def reload_table(
    spark: SparkSession, df: DataFrame, path: str, id_col: str, order: str | None = None
) -> None:
    """Empty the table and load it anew. Its serial ids go on counting where the last load ended.

    Rows are numbered by ``order``; without it they bring the numbers 1, 2, 3 … as their id. The last id
    given is kept next to the table, so that an empty load doesn't start the numbers again.
    """
    counter = f"{path.rstrip('/')}_last_id"
    last_id = 0
    for known in (counter, path):
        if path_exists(spark, known):
            last_id = max(last_id, spark.read.parquet(known).agg(F.max(id_col)).first()[0] or 0)
    # Written first: a load that fails afterwards leaves a gap in the numbers, never a number given twice.
    spark.createDataFrame([(last_id,)], f"{id_col} long").write.mode("overwrite").parquet(counter)
    number = id_col
    if order is not None:
        df, number = rank_by_id(df, order, name="_serial"), "_serial"
    rest = [name for name in df.columns if name not in (id_col, order, number)]
    df.select((F.col(number) + last_id).alias(id_col), *rest).write.mode("overwrite").parquet(path)


def reload_version(spark: SparkSession, df: DataFrame, path: str, id_col: str, order: str) -> int:
    """``reload_table`` for a versioned table: readers see the old rows until all new ones are there.

    Ids go on counting after the highest of all versions that are kept; an empty version keeps the count.
    """
    last_id, base = 0, versions.current_version(spark, path)
    for version in versions.versions(spark, path):
        last_id = max(last_id, versions.read_version(spark, path, version).agg(F.max(id_col)).first()[0] or 0)
    ranked = rank_by_id(df, order, name="_serial")
    rest = [name for name in ranked.columns if name not in (id_col, order, "_serial")]
    rows = ranked.select((F.col("_serial") + last_id).alias(id_col), *rest)
    return versions.publish(spark, rows, path, base)


def merge_version(spark: SparkSession, path: str, incoming: DataFrame, merge: Merge) -> int:
    """Merges a batch into a versioned table; of two writers that began with one version, one gets Conflict."""
    base = versions.current_version(spark, path)
    stored = versions.read_version(spark, path, base) if base else spark.createDataFrame([], incoming.schema)
    return versions.publish(spark, merge(stored.select(*incoming.columns), incoming), path, base)


def write_merged(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    merge: Merge,
    partition: str | None = None,
) -> None:
    """Merge a batch into a table. With ``partition`` only the partitions it touches are rewritten.

    The merged rows are staged next to the table first, because a table cannot be read and overwritten
    in one plan. While they replace the old ones the stage is the only complete copy, so every call
    begins by finishing a stage that an earlier batch, whichever it was, has left. What was staged is
    removed when the table is complete.
    """
    layout = [partition] if partition else []
    _finish_replacement(spark, path, incoming, layout)
    arrived, staging = f"{path.rstrip('/')}_incoming", f"{path.rstrip('/')}_staging"
    # The merge reads the batch several times; written down it is computed once.
    incoming.write.mode("overwrite").parquet(arrived)
    incoming = spark.read.schema(incoming.schema).parquet(arrived)
    merged = merge(stored_rows(spark, path, incoming, partition), incoming)
    if partition:
        # Splits the files of a partition that holds most rows, joins those of small ones.
        merged = merged.hint("rebalance", partition)
    merged.write.mode("overwrite").parquet(staging)
    # Only a complete stage gets this name.
    rename_path(spark, staging, f"{path.rstrip('/')}_stage")
    _finish_replacement(spark, path, incoming, layout)
    delete_path(spark, arrived)


def _finish_replacement(spark: SparkSession, path: str, like: DataFrame, layout: list[str]) -> None:
    """Puts staged rows in place of the old ones, again and again if need be; then removes the stage."""
    stage = f"{path.rstrip('/')}_stage"
    if not path_exists(spark, stage):
        return
    writer = spark.read.schema(like.schema).parquet(stage).write.mode("overwrite")
    if layout:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*layout)
    writer.parquet(path)
    delete_path(spark, stage)


def stored_rows(
    spark: SparkSession, path: str, incoming: DataFrame, partition: str | None = None
) -> DataFrame:
    """The rows of a table that a batch can change: those of the partitions it touches."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], incoming.schema)
    stored = spark.read.schema(incoming.schema).parquet(path)
    if partition:
        # Their names are folders of the table, months or buckets. As literals they prune the scan.
        touched = [row[0] for row in incoming.select(partition).distinct().collect()]
        stored = stored.where(F.col(partition).isin(touched))
    return stored.select(*incoming.columns)
