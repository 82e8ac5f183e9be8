"""Constraints on write, and change records."""

import random

from pyspark.sql import functions as F

from hirelake import schemas
from hirelake.operators import enforce, versions
from hirelake.session import folders_in
from hirelake.streaming import changes, jobs

TABLE = schemas.Table(
    "presentation", "things", "k STRING, n INT, label STRING, dim STRING", key=("k",), not_null=("n",), limits={"label": 3}
)
ROWS = [
    ("a", 1, "abc", "x"),
    ("b", None, "abcd", "x"),
    (None, 2, "a", "y"),
    ("c", 3, None, None),
    ("d", 4, "a", "zzz"),
    ("e", 5, "new", "x"),
    ("e", 6, "old", "x"),
]
KEYS = [("x",), ("x",), ("y",), (None,)]


def test_accepted_and_refused_rows(spark, tmp_path):
    rows = spark.createDataFrame(ROWS, "k string, n int, label string, dim string")
    dims = {"dim": (spark.createDataFrame(KEYS, "pk string"), "pk")}
    path = f"{tmp_path}/things"
    outcome = enforce.write_enforced(spark, rows, TABLE, path, dims, [F.col("n")])
    assert outcome == (1, 7, 3)
    assert sorted(r["k"] for r in enforce.accepted_rows(spark, path).collect()) == ["a", "c", "e"]
    refused = {(r["k"], r["n"]): r["reasons"] for r in enforce.quarantined_rows(spark, path).collect()}
    assert refused == {
        ("b", None): ["no value: n", "too long: label"],
        (None, 2): ["null key: k"],
        ("d", 4): ["no such key: dim"],
        ("e", 5): ["duplicate key"],
    }
    assert enforce.accepted_rows(spark, path).columns == rows.columns
    plan = enforce.accepted_rows(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(accepted" in plan  # quarantined files aren't opened


def test_one_scan_without_duplicates_to_find(spark, tmp_path):
    spark.createDataFrame(ROWS, "k string, n int, label string, dim string").write.parquet(f"{tmp_path}/in")
    checked = enforce.checked(spark.read.parquet(f"{tmp_path}/in"), TABLE)
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_nothing_to_write_and_a_later_version(spark, tmp_path):
    path = f"{tmp_path}/things"
    none = spark.createDataFrame([], "k string, n int, label string, dim string")
    assert enforce.write_enforced(spark, none, TABLE, path) == (1, 0, 0)
    assert enforce.accepted_rows(spark, path).count() == 0 == enforce.quarantined_rows(spark, path).count()
    some = spark.createDataFrame(ROWS[:1], none.schema)
    assert enforce.write_enforced(spark, some, TABLE, path) == (2, 1, 1)
    assert versions.versions(spark, path) == [1, 2]


SCHEMA = "seq long, k string, v int, op string"


def random_changes(draw, n):
    ops = ["insert", "update", "delete"]
    return [(s, draw.choice("abcdefgh"), draw.randrange(100), draw.choice(ops)) for s in range(1, n + 1)]


def expected(rows):
    last = {}
    for row in sorted(r for r in rows if r[0] is not None and r[1] is not None):
        last[row[1]] = row
    return sorted((s, k, v) for s, k, v, op in last.values() if op != "delete")


class Feed:
    """A folder of files that arrive, and the stream that takes them."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.out, self.n = spark, folder, f"{folder}/out", 0
        self.schema = spark.createDataFrame([], SCHEMA).schema

    def arrive(self, rows):
        self.n += 1
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.folder}/in")

    def run(self, checkpoint="checkpoint", files=None):
        stream = jobs.arriving_files(self.spark, f"{self.folder}/in", self.schema, files)
        changes.apply_changes(stream, ["k"], "seq", self.out, f"{self.folder}/{checkpoint}").awaitTermination()

    def compact(self, settled=None):
        changes.compact_changes(self.spark, self.out, self.schema, ["k"], "seq", settled)

    def rows(self):
        found = changes.current_rows(self.spark, self.out, self.schema, ["k"], "seq")
        return sorted((r["seq"], r["k"], r["v"]) for r in found.collect())


def test_stream_equals_batch_in_any_order(spark, tmp_path):
    draw = random.Random(3)
    feed, rows = Feed(spark, str(tmp_path)), random_changes(draw, 60)
    draw.shuffle(rows)
    rows.insert(5, (1_000, None, 1, "insert"))
    rows.insert(6, (None, "a", 1, "insert"))
    for at in range(0, len(rows), 20):
        feed.arrive(rows[at : at + 20])
        feed.run(files=1)
        if at == 20:
            feed.compact()
    assert feed.rows() == expected(rows)
    feed.run("another")  # all of it once more
    assert feed.rows() == expected(rows)
    feed.compact()
    assert feed.rows() == expected(rows) and len(folders_in(spark, feed.out)) == 1


def test_late_changes_and_dropped_tombstones(spark, tmp_path):
    feed = Feed(spark, str(tmp_path))
    feed.arrive([(1, "a", 10, "insert"), (2, "b", 20, "insert"), (5, "a", 0, "delete"), (9, "c", 1, "insert")])
    feed.run()
    assert feed.rows() == [(2, "b", 20), (9, "c", 1)]
    feed.arrive([(3, "a", 11, "update"), (8, "c", 0, "delete")])  # a late update and a late delete
    feed.run()
    assert feed.rows() == [(2, "b", 20), (9, "c", 1)]
    feed.compact(settled=6)
    stored = spark.read.schema(SCHEMA).parquet(feed.out)
    assert stored.where("op = 'delete'").count() == 0 and changes.settled_at(spark, feed.out) == 6
    feed.run("another")  # a replay brings the update of seq 3 again: it must not come back to life
    assert feed.rows() == [(2, "b", 20), (9, "c", 1)]
    feed.compact(settled=4)  # a lower bound takes nothing back
    assert changes.settled_at(spark, feed.out) == 6
    feed.arrive([(12, "a", 13, "insert")])
    feed.run()
    assert feed.rows() == [(2, "b", 20), (9, "c", 1), (12, "a", 13)]


def test_no_changes(spark, tmp_path):
    feed = Feed(spark, str(tmp_path))
    assert feed.rows() == []
    feed.compact(settled=3)
    assert feed.rows() == []
