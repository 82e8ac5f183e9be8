"""Structured Streaming versions of the ingest, the upsert and the daily count.

Each job runs with ``trigger(availableNow=True)``: it takes what has arrived since its last run, in
micro-batches, and stops. Progress and state live under the checkpoint path; tables are folders of deltas.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hirelake.operators.keyed import first_wins, one_per_key
from hirelake.session import delete_path, folders_in, is_folder


def arriving_files(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """The Parquet files of a landing folder, or one such file, as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if not is_folder(spark, path):
        # A stream reads folders: this one takes the named file of its folder only.
        path, name = path.rsplit("/", 1)
        reader = reader.option("pathGlobFilter", name)
    return reader.parquet(path)


def written_rows(spark: SparkSession, path: str, schema) -> DataFrame:
    """What a stream has written; nothing if nothing has arrived yet."""
    if not folders_in(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(path)
    return rows.drop("delta")  # the name of the folder


def write_delta(batch: DataFrame, out: str, batch_id: int) -> None:
    """One folder per batch; a replayed batch replaces its own."""
    batch.write.mode("overwrite").parquet(f"{out}/delta=batch-{batch_id}")


def compact(spark: SparkSession, out: str, schema, reduced: Callable[[DataFrame], DataFrame]) -> None:
    """Puts all deltas of a table into one. To be run now and then, between runs of the stream.

    ``reduced`` gives the rows that count, and gives them again from themselves and any rows they come
    from. So a job that is lost after it wrote the new delta, and before it removed the old ones, does
    no harm, nor does a batch that is replayed later.
    """
    old = folders_in(spark, out)
    if len(old) > 1:
        rows = spark.read.schema(schema).parquet(*[f"{out}/{name}" for name in old])
        reduced(rows).write.parquet(f"{out}/delta=compact-{uuid.uuid4().hex}")
        for name in old:
            delete_path(spark, f"{out}/{name}")


def _run(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_once(stream: DataFrame, keys: Sequence[str], arrival: str, out: str, checkpoint: str) -> StreamingQuery:
    """Append the first arrival of each key, for all time: what is stored refuses later ones.

    The query itself keeps no state. A batch looks for its own keys among the stored ones only; the
    stored rows are not rewritten, and below the broadcast threshold not shuffled either. Rows with a
    NULL in their key are refused, as a primary key would.
    """
    spark, keys, schema = stream.sparkSession, list(keys), stream.schema

    def append_new(batch: DataFrame, batch_id: int) -> None:
        incoming = first_wins(batch, keys, arrival).persist()
        earlier = [f"{out}/{name}" for name in folders_in(spark, out) if name != f"delta=batch-{batch_id}"]
        stored = spark.read.schema(schema).parquet(*earlier) if earlier else spark.createDataFrame([], schema)
        known = stored.select(*keys).join(incoming.select(*keys), keys, "left_semi")
        write_delta(incoming.join(known, keys, "left_anti").select(*batch.columns), out, batch_id)
        incoming.unpersist()

    return _run(stream, append_new, checkpoint)


def upsert_newest(
    stream: DataFrame, keys: Sequence[str], newest: Sequence[str], out: str, checkpoint: str
) -> StreamingQuery:
    """Keep the newest row per key, by the columns ``newest`` (descending).

    A batch appends the newest of its rows as a delta and reads nothing that is stored; ``newest_rows``
    reads the table, ``compact`` with the same order keeps the number of deltas small.
    """
    order = [F.desc(name) for name in newest]
    return _run(stream, lambda batch, n: write_delta(one_per_key(batch, list(keys), order), out, n), checkpoint)


def newest_rows(spark: SparkSession, out: str, schema, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """The rows of a table that ``upsert_newest`` writes."""
    return one_per_key(written_rows(spark, out, schema), list(keys), [F.desc(name) for name in newest])


def compact_newest(spark: SparkSession, out: str, schema, keys: Sequence[str], newest: Sequence[str]) -> None:
    compact(spark, out, schema, lambda rows: one_per_key(rows, list(keys), [F.desc(name) for name in newest]))


COUNTS = "day DATE, n_events BIGINT, batch BIGINT"


def count_per_day(stream: DataFrame, event_time: str, delay: str, out: str, checkpoint: str) -> StreamingQuery:
    """Arrivals per day, kept current while days are still open.

    Every batch writes the days it changed, with its own number, so a replay replaces its own output.
    Rows later than the delay no longer count. ``current_counts`` reads the table, ``compact_counts``
    keeps its number of folders small.
    """
    days = (
        stream.select(F.col(event_time).cast("timestamp").alias("event_time"))
        .withWatermark("event_time", delay)
        .groupBy(F.window("event_time", "1 day"))
        .agg(F.count(F.lit(1)).alias("n_events"))
        .select(F.col("window.start").cast("date").alias("day"), "n_events")
    )
    write = lambda batch, n: write_delta(batch.withColumn("batch", F.lit(n).cast("long")), out, n)
    return _run(days, write, checkpoint, "update")


def _latest_counts(written: DataFrame) -> DataFrame:
    return one_per_key(written, ["day"], [F.desc("batch")])


def current_counts(spark: SparkSession, out: str) -> DataFrame:
    """The latest count of each day."""
    return _latest_counts(written_rows(spark, out, COUNTS)).select("day", "n_events")


def compact_counts(spark: SparkSession, out: str) -> None:
    compact(spark, out, COUNTS, _latest_counts)
