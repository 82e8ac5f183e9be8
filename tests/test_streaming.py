"""Streams in several micro-batches give what one batch gives."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hirelake.operators.keyed import first_wins, one_per_key
from hirelake.session import folders_in, scratch_path
from hirelake.sources import fixtures
from hirelake.streaming import jobs

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def arriving(spark):
    """The events in five files, by time, as a stream of one file per batch."""
    events = fixtures.arrivals(spark, FOLDER)
    folder = scratch_path(spark, "arrivals")
    part = F.floor((F.col("event_id") * 5) / events.count())
    for number in range(5):
        events.where(part == number).coalesce(1).write.mode("append").parquet(folder)

    def stream():
        return jobs.arriving_files(spark, folder, events.schema, files_per_batch=1)

    return events, stream


def test_a_folder_without_files_gives_no_rows(spark):
    events = fixtures.arrivals(spark, FOLDER)
    folder, out, checkpoint = (scratch_path(spark, n) for n in ("empty", "out", "checkpoint"))
    events.limit(0).write.parquet(folder)
    jobs.upsert_newest(
        jobs.arriving_files(spark, folder, events.schema), ["user_id"], ["ts"], out, checkpoint
    ).awaitTermination()
    assert jobs.written_rows(spark, out, events.schema).count() == 0


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_ingest_keeps_the_first_of_each_key_for_all_time(spark, arriving):
    events, stream = arriving
    out = scratch_path(spark, "out")
    keys = ["user_id", "event_type"]
    expected = rows(first_wins(events, keys, "event_id"))
    checkpoint = scratch_path(spark, "checkpoint")
    for folder in (checkpoint, checkpoint, scratch_path(spark, "again")):
        # The last run starts over, long after: every arrival is refused.
        jobs.ingest_once(stream(), keys, "event_id", out, folder).awaitTermination()
        assert rows(jobs.written_rows(spark, out, events.schema)) == expected


def test_upsert_equals_batch_goes_on_and_is_compacted(spark, arriving):
    events, stream = arriving
    out, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    keys, newest = ["user_id", "event_type"], ["ts", "event_id"]
    expected = rows(one_per_key(events, keys, [F.desc(n) for n in newest]))

    def found():
        return rows(jobs.newest_rows(spark, out, events.schema, keys, newest))

    jobs.upsert_newest(stream(), keys, newest, out, checkpoint).awaitTermination()
    folders = folders_in(spark, out)
    assert len(folders) == 5 and found() == expected
    # Nothing new: no folder changes. Compaction leaves one; a replay on it changes nothing.
    jobs.upsert_newest(stream(), keys, newest, out, checkpoint).awaitTermination()
    assert folders_in(spark, out) == folders
    jobs.compact_newest(spark, out, events.schema, keys, newest)
    assert len(folders_in(spark, out)) == 1 and found() == expected
    jobs.upsert_newest(stream(), keys, newest, out, scratch_path(spark, "again")).awaitTermination()
    assert found() == expected


def test_daily_count_equals_batch(spark, arriving):
    events, stream = arriving
    out, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    jobs.count_per_day(stream(), "ts", "40 days", out, checkpoint).awaitTermination()
    expected = events.groupBy(F.col("ts").cast("date").alias("day")).count()
    assert rows(jobs.current_counts(spark, out)) == rows(expected)
    jobs.compact_counts(spark, out)
    assert len(folders_in(spark, out)) == 1 and rows(jobs.current_counts(spark, out)) == rows(expected)
    assert jobs.current_counts(spark, out).agg(F.min("day")).first()[0] == dt.date(2024, 1, 1)
