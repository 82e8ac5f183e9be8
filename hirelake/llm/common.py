"""Helpers that several operators share: stored tables, distributed prefix sums, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelake.session import scratch_path

# Words of the contracts: what lies between blanks and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder and read back from there.

    Cuts the lineage: what follows doesn't depend on an executor that may be lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spare(taken: Sequence[str], name: str) -> str:
    """``name``, with underscores in front until no column has it (case does not distinguish them)."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def range_sorted(df: DataFrame, order: Sequence[str], name: str, part: str = "part") -> DataFrame:
    """The rows range-partitioned by ``order`` and stored with the number of their range in ``part``.

    The bounds come from a sample of each run, so the result is stored before anything relies on them.
    """
    keys = [F.col(c) for c in order]
    ranged = df.repartitionByRange(*keys).withColumn(part, F.spark_partition_id())
    return stored(ranged, name)


def prefix_sums(
    df: DataFrame, group: str, order: Sequence[str], value: str, out: str = "before", part: str = "part"
) -> DataFrame:
    """Adds to each row the sum of ``value`` over the rows before it in its group.

    No task sees a whole group: ranges of it are summed, the sums of the ranges before are added to
    the running sum inside one range. ``group`` holds no NULL; rows that tie in ``order`` are summed
    in any order.
    """
    ranged = range_sorted(df, [group, *order], "ranges", part)
    # One row per group and range; a group has at most as many ranges as the shuffle has partitions.
    sums = ranged.groupBy(group, part).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(group, part, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(group, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    running = ranged.withColumn("_running", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = running.join(offsets, [group, part])
    return joined.withColumn(out, F.col("_offset") + F.col("_running")).drop("_offset", "_running")


def word_count(text: Column | str) -> Column:
    """Number of words; 0 without a text."""
    text = F.col(text) if isinstance(text, str) else text
    # One blank between words, none at the ends: the words are then one more than the blanks.
    blanks = r"[\x20\x09-\x0D]+"
    words = F.size(F.split(text, blanks))
    leading = F.when(text.rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    trailing = F.when(text.rlike(r"[\x20\x09-\x0D]\z"), 1).otherwise(0)
    counted = F.when(text.rlike(r"[^\x20\x09-\x0D]"), words - leading - trailing).otherwise(0)
    return F.coalesce(counted, F.lit(0)).cast("long")


def remainder(doc_id: Column | str, parts: int) -> Column:
    """crc32 of the document number as text, modulo ``parts``; NULL without a number."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id) % parts


def some_rows(batch: pa.RecordBatch, most: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``most`` bytes each, so that very long texts don't add up."""
    rows = max(1, int(batch.num_rows * most / max(batch.nbytes, 1)))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
