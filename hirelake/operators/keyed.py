"""Operators on keyed rows: one winner per key, insert-if-absent, upsert, dense ranks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def with_whole_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key has no NULL part; a primary key admits no others."""
    return df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark limits each key to one row per input partition before the shuffle (WindowGroupLimit),
    so a key that holds a third of all rows reaches its task as one row per partition.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def first_wins(df: DataFrame, keys: Sequence[str], arrival: str) -> DataFrame:
    """The earliest arrival of each whole key."""
    return one_per_key(with_whole_key(df, keys), keys, [F.col(arrival).asc()])


def insert_if_absent(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], arrival: str) -> DataFrame:
    """The incoming rows that an insert accepts: first of their key, and the key is new."""
    known = existing.select(*keys)
    return first_wins(incoming, keys, arrival).join(known, list(keys), "left_anti").select(*incoming.columns)


def upsert(target: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """The target after a Type-1 upsert: an incoming row replaces the stored row of its key.

    ``order`` decides between incoming rows of one key; its columns need not exist in the target.
    Stored rows are kept by an anti join, which a small batch turns into a broadcast join, so that
    a large target is not shuffled. Keys of the incoming rows are unique by then.
    """
    batch = with_whole_key(incoming, keys)
    winners = one_per_key(batch, keys, order) if order else batch
    winners = winners.select(*target.columns)
    kept = target.join(winners.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(winners)


def keep_newest(target: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The target after an upsert in which the newest row wins, whichever batch it came with."""
    return one_per_key(target.unionByName(with_whole_key(incoming, keys)), keys, order)


_LOW_BITS, _HIGH_BITS = 16, 40


def rank_by_id(df: DataFrame, id_col: str, group: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """Number the rows 1, 2, 3 … by a unique integer id, within each group.

    A window over a whole group would put a hot group, or all rows, into one task. Here ids are cut
    into blocks of 2**16: rows are ranked inside their block, and counts of the blocks before it are
    added. Blocks are summed in spans of 2**40 ids first, so no window sees more than 2**24 rows.
    """
    # Keys are structs because a NULL inside a struct equals another NULL: such groups count too.
    in_block = F.struct(*group, F.shiftright(id_col, _LOW_BITS).alias("_block"))
    in_span = F.struct(*group, F.shiftright(id_col, _HIGH_BITS).alias("_span"))
    blocks = df.groupBy(in_block.alias("_in_block"), in_span.alias("_in_span")).agg(F.count(F.lit(1)).alias("_n"))
    spans = blocks.groupBy("_in_span").agg(F.sum("_n").alias("_n"))

    def before(partition: list[Column], order: str) -> Column:
        window = W.partitionBy(*partition).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
        return F.coalesce(F.sum("_n").over(window), F.lit(0))

    groups = [F.col(f"_in_span.{name}") for name in group]
    span_starts = spans.select("_in_span", before(groups, "_in_span._span").alias("_span_start"))
    starts = (
        blocks.withColumn("_earlier", before([F.col("_in_span")], "_in_block._block"))
        .join(span_starts, "_in_span")
        .select("_in_block", (F.col("_span_start") + F.col("_earlier")).alias("_start"))
    )
    local = F.row_number().over(W.partitionBy("_in_block").orderBy(id_col))
    return (
        df.withColumn("_in_block", in_block)
        .withColumn("_local", local)
        .join(starts, "_in_block")
        .select(*df.columns, (F.col("_start") + F.col("_local")).alias(name))
    )


def every_second_row(df: DataFrame, id_col: str, group: Sequence[str] = ()) -> DataFrame:
    """The first, third, fifth … row of each group by id."""
    return rank_by_id(df, id_col, group, "_place").where("_place % 2 = 1").drop("_place")
