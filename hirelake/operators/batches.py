"""Training batches of growing size over texts in a seeded order."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Words of the first batch and of the largest, growth per batch, share a text may exceed it by.
START, STOP, COMPOUND, TOLERANCE = 100, 1000, 1.001, 0.2
WORD = r"[\p{L}\p{N}_]+"
# Leading digits of the order key: rows are summed inside blocks, blocks inside spans.
_BLOCK_DIGITS, _SPAN_DIGITS = 5, 2
_ROUNDING = 1e-9  # a boundary that is met exactly belongs to the batch it begins


def words_before(docs: DataFrame, id_col: str, text: str, seed: int = 0, epoch: int = 0) -> DataFrame:
    """id, n_words and words_before: the words of all texts before it in the epoch's order.

    The order is that of a hash of seed, epoch and id, so it is another one in each epoch and the same in
    every run. The hash's leading digits cut it into blocks of like size. Words are summed within blocks;
    sums of the blocks before are added, and sums of the spans of blocks before those, so no window sees
    more than a millionth of the rows or 4,096 sums. ``id_col`` tells rows apart; NULL texts have no words.
    """
    key = F.md5(F.concat_ws(":", F.lit(seed), F.lit(epoch), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    n_words = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    sized = docs.select(F.col(id_col).alias("id"), n_words.alias("n_words"), key.alias("_key")).withColumns(
        {"_block": F.substring("_key", 1, _BLOCK_DIGITS), "_span": F.substring("_key", 1, _SPAN_DIGITS)}
    )
    blocks = sized.groupBy("_block", "_span").agg(F.sum("n_words").alias("_n"))
    spans = blocks.groupBy("_span").agg(F.sum("_n").alias("_n"))

    def before(value: str, *partition: str, order: tuple[str, ...]) -> Column:
        window = W.partitionBy(*partition).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
        return F.coalesce(F.sum(value).over(window), F.lit(0))

    span_starts = spans.select("_span", before("_n", order=("_span",)).alias("_span_start"))
    starts = (
        blocks.withColumn("_earlier", before("_n", "_span", order=("_block",)))
        .join(span_starts, "_span")
        .select("_block", (F.col("_span_start") + F.col("_earlier")).alias("_start"))
    )
    local = sized.withColumn("_local", before("n_words", "_block", order=("_key", "id")))
    return local.join(starts, "_block").select(
        F.col("id").alias(id_col), "n_words", (F.col("_start") + F.col("_local")).alias("words_before")
    )


def batch_at(words: Column, start: float = START, stop: float = STOP, compound: float = COMPOUND) -> Column:
    """Number of the batch, from 0, that a running count of words falls into.

    Batch k holds start * compound^k words, but not more than stop. Before the size stops growing the sums
    are those of a geometric series, so the number is a logarithm; afterwards it is a quotient.
    """
    if compound <= 1 or stop <= start:
        return F.floor(words / float(min(start, stop)) + _ROUNDING)
    steps = math.ceil(math.log(stop / start) / math.log(compound))
    grown = start * (compound**steps - 1) / (compound - 1)
    growing = F.floor(F.log(1 + words * (compound - 1) / start) / math.log(compound) + _ROUNDING)
    return F.when(words < grown, growing).otherwise(steps + F.floor((words - grown) / float(stop) + _ROUNDING))


def training_batches(
    docs: DataFrame,
    id_col: str,
    text: str,
    seed: int = 0,
    epoch: int = 0,
    start: float = START,
    stop: float = STOP,
    compound: float = COMPOUND,
    tolerance: float = TOLERANCE,
    discard_oversize: bool = False,
) -> DataFrame:
    """id, n_words, words_before and batch of every text, for one pass over all of them.

    A text belongs to the batch into which its first word falls, whole. With ``discard_oversize`` texts
    that alone exceed their batch's size by more than ``tolerance`` are left out.
    """
    placed = words_before(docs, id_col, text, seed, epoch)
    batched = placed.withColumn("batch", batch_at(F.col("words_before"), start, stop, compound).cast("long"))
    if not discard_oversize:
        return batched
    size = F.least(F.lit(float(stop)), F.lit(float(start)) * F.pow(F.lit(float(compound)), F.col("batch")))
    return batched.where(F.col("n_words") <= size * (1 + tolerance))
