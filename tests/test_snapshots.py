"""Daily counts that follow upserts."""

import datetime as dt
import random

from pyspark.sql import functions as F

from hirelake.operators import snapshots, versions

ROWS = "k string, id long, updated timestamp_ntz"


def order():
    return [F.desc("updated"), F.desc("id")]


def adverts(draw, n):
    start = dt.datetime(2024, 1, 1)
    return [(draw.choice("abcdefghij"), i, start + dt.timedelta(hours=draw.randrange(240))) for i in range(n)]


def counted(rows):
    last = {}
    for k, i, at in rows:
        if k is not None and (k not in last or (at, i) > last[k]):
            last[k] = (at, i)
    days = [at.date() for at, _ in last.values()]
    return sorted((d, days.count(d)) for d in set(days))


def found(spark, path):
    return sorted((r["snap_date"], r["open_ads"]) for r in versions.read_version(spark, path).collect())


def test_counts_equal_recounting_after_every_batch(spark, tmp_path):
    draw, fact, counts, seen = random.Random(2), f"{tmp_path}/fact", f"{tmp_path}/counts", []
    rows = adverts(draw, 40) + [(None, 99, dt.datetime(2024, 1, 1))]
    draw.shuffle(rows)
    batches = [rows[:10], rows[10:25], rows[:10], [], rows[25:]]  # one comes again, one is empty
    for batch in batches:
        seen += batch
        incoming = spark.createDataFrame(batch, ROWS)
        snapshots.upsert_counted(spark, fact, counts, incoming, ["k"], order(), "updated")
        assert found(spark, counts) == counted(seen)


def test_counts_that_were_left_behind_are_made_anew(spark, tmp_path):
    draw, fact, counts = random.Random(4), f"{tmp_path}/fact", f"{tmp_path}/counts"
    first, second = adverts(draw, 12), [("z", 500, dt.datetime(2024, 2, 1))]
    snapshots.upsert_counted(spark, fact, counts, spark.createDataFrame(first, ROWS), ["k"], order(), "updated")
    versions.publish(spark, versions.read_version(spark, fact), fact)  # a fact whose counts were lost
    snapshots.upsert_counted(spark, fact, counts, spark.createDataFrame(second, ROWS), ["k"], order(), "updated")
    assert found(spark, counts) == counted(first + second)


def test_a_batch_is_computed_once(spark, tmp_path):
    reads, rows = spark.sparkContext.accumulator(0), adverts(random.Random(3), 20)

    def read(key):
        reads.add(1)
        return key

    for half in (rows[:10], rows[10:]):
        batch = spark.createDataFrame(half, ROWS).withColumn("k", F.udf(read, "string").asNondeterministic()("k"))
        snapshots.upsert_counted(spark, f"{tmp_path}/fact", f"{tmp_path}/counts", batch, ["k"], order(), "updated")
    assert reads.value <= len(rows)
    assert found(spark, f"{tmp_path}/counts") == counted(rows)
