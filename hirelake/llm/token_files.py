"""Token ids as Parquet files that are read in part.

One row per document: its number, its range of tokens, and the ids as a list column. The ids are
dictionary-encoded, for a file uses few of a vocabulary's ids; the numbers, which ascend, are
delta-encoded. Row groups and pages are small enough that a filter on the number, or a selection of
columns, reads little else: page indexes hold the bounds of every page.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelake.llm.common import some_rows
from hirelake.llm.tokens import encoder, in_lots, vocabulary

VOCABULARY, END_ID = "byte_bpe_50k.json", 0
ROW_GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 32 << 20, 256 << 10, 2048
ENCODED_AT_ONCE = 4 << 20  # bytes of texts
SCHEMA = "doc_id long, part int, part_start long, n_tokens int, ids array<int>"
ENCODINGS = {
    "parquet.writer.version": "PARQUET_2_0",  # delta encoding of what has no dictionary
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#ids.list.element": "true",
    "parquet.dictionary.page.size": str(1 << 20),
}


def write_token_files(
    docs: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary_path: str | None = None,
    end_id: int = END_ID,
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
    page_rows: int = PAGE_ROWS,
) -> None:
    """Encodes whole texts (NULL: empty), appends ``end_id`` to each and writes them by ascending number.

    File ``part`` holds the documents of one range of numbers; ``part_start`` counts the tokens of the
    documents before in the same part. A missing number sorts first; rows that share one are ordered by
    their texts, and each is written. Other columns are not. The texts are range-partitioned before
    they are encoded, because they are smaller than their ids.
    """
    vocabulary_path = vocabulary_path or vocabulary(VOCABULARY)
    end = np.array([end_id], "<u4").tobytes()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for whole in batches:
            for batch in some_rows(whole):
                batch.column(1).validate(full=True)  # refuses what isn't UTF-8
                texts = batch.column(1).cast(pa.large_binary()).to_pylist()
                for at, to in in_lots(texts, ENCODED_AT_ONCE):
                    lengths, flat = encoder(vocabulary_path).flat(texts[at:to], end)
                    ends = np.cumsum(lengths)
                    offsets = np.r_[0, ends].astype(np.int32)
                    columns = [
                        batch.column(0).slice(at, to - at),
                        pa.array(np.full(to - at, part, np.int32)),
                        pa.array(before + ends - lengths),
                        pa.array(lengths.astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    ]
                    before += int(ends[-1])
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "part_start", "n_tokens", "ids"])

    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # Ties are told apart by a hash, so rows without a number, or with one number, are dealt to several files.
    tie = F.xxhash64("text")
    ordered = texts.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    options = ENCODINGS | {
        "compression": "zstd",
        "parquet.block.size": str(row_group_bytes),
        "parquet.page.size": str(page_bytes),
        "parquet.page.row.count.limit": str(page_rows),
    }
    ordered.mapInArrow(encoded, SCHEMA).write.options(**options).parquet(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, part, start (tokens of all documents before) and n_tokens, without reading any id."""
    return _with_start(spark, path, "doc_id", "part", "n_tokens")


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """doc_id, start, n_tokens and ids, of all documents or of those numbered from ``first`` to ``last``.

    The bounds reach the scan, where row groups and pages outside are skipped.
    """
    rows = _with_start(spark, path, "doc_id", "n_tokens", "ids")
    if first is not None:
        rows = rows.where(F.col("doc_id") >= first)
    return rows if last is None else rows.where(F.col("doc_id") <= last)


def _with_start(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    files = spark.read.schema(SCHEMA).parquet(path)
    # One row per file: the tokens of the parts before. There are no more files than the shuffle that
    # wrote them had partitions, so this table is small at any size of input and may be broadcast.
    sums = files.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("before"))
    start = (F.col("before") + F.col("part_start")).alias("start")
    at = [F.col("doc_id"), start, *[F.col(c) for c in columns if c != "doc_id"]]
    return files.join(F.broadcast(starts), "part").select(*at)


def with_checksums(tokens: DataFrame, name: str = "ids_crc32") -> DataFrame:
    """Replaces ``ids`` by the crc32 of all of them as little-endian unsigned 32-bit integers."""
    kept = [c for c in tokens.columns if c not in ("ids", name)]
    schema = ", ".join([*(f"`{c}` {tokens.schema[c].dataType.simpleString()}" for c in kept), f"`{name}` long"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            offsets = (lists.offsets.to_numpy() * 4).tolist()
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False).astype("<i4"))).cast("B")
            sums = [zlib.crc32(raw[a:b]) for a, b in zip(offsets, offsets[1:])]
            columns = [batch.column(c) for c in kept] + [pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, name])

    return tokens.select(*kept, "ids").mapInArrow(summed, schema)
