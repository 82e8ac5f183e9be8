"""Change records: inserts, updates and deletes with a sequence number, applied to a table by key.

A batch appends the last change of each of its keys as a delta, deletes as tombstones. The table is the
last change of each key that is no tombstone, so order of arrival, repeats and replays don't matter: a
delete that comes late does not remove a newer row, and a row that comes late does not undo a delete.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hirelake.operators.keyed import one_per_key, with_whole_key
from hirelake.session import delete_path, files_in, folders_in, write_text
from hirelake.streaming.jobs import _run, compact, write_delta, written_rows

DELETE = "delete"


def last_changes(rows: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """The change with the highest sequence number of each key; sequence numbers tell changes apart."""
    return one_per_key(rows, list(keys), [F.desc(sequence)])


def settled_at(spark: SparkSession, out: str) -> int | None:
    """The sequence number up to which changes are no longer taken; None if all are."""
    marks = files_in(spark, f"{out.rstrip('/')}_settled")
    return max(map(int, marks), default=None)


def apply_changes(
    stream: DataFrame, keys: Sequence[str], sequence: str, out: str, checkpoint: str
) -> StreamingQuery:
    """Appends the changes of a stream whose column ``op`` says insert, update or delete.

    An update of an absent key inserts it, an insert of a present one updates it. Changes with a NULL in
    their key or without a sequence number are left out, and so are those up to the settled one.
    """
    spark, out = stream.sparkSession, out.rstrip("/")

    def append(batch: DataFrame, number: int) -> None:
        changes, settled = with_whole_key(batch, list(keys)).where(F.col(sequence).isNotNull()), settled_at(spark, out)
        if settled is not None:
            changes = changes.where(F.col(sequence) > settled)
        write_delta(last_changes(changes, keys, sequence), out, number)

    return _run(stream, append, checkpoint)


def current_rows(spark: SparkSession, out: str, schema, keys: Sequence[str], sequence: str, op: str = "op") -> DataFrame:
    """The table: what the last change of each key left."""
    return last_changes(written_rows(spark, out, schema), keys, sequence).where(F.col(op) != DELETE).drop(op)


def compact_changes(
    spark: SparkSession, out: str, schema, keys: Sequence[str], sequence: str, settled: int | None = None, op: str = "op"
) -> None:
    """Puts all deltas into one, between runs of the stream, and drops tombstones that are settled.

    ``settled`` is a sequence number up to which every change has arrived. It is noted first: later
    batches, replayed ones included, can then bring nothing older that a dropped tombstone had undone.
    Tombstones go only when one folder is all there is. Whenever the job is lost, the rows stay right.
    """
    out = out.rstrip("/")
    compact(spark, out, schema, lambda rows: last_changes(rows, keys, sequence))
    folders = folders_in(spark, out)
    if settled is None or len(folders) != 1:
        return
    if (settled_at(spark, out) or settled - 1) < settled:
        write_text(spark, f"{out}_settled/{settled}", "")
    rows = spark.read.schema(schema).parquet(f"{out}/{folders[0]}")
    done = (F.col(op) == DELETE) & (F.col(sequence) <= settled)
    if rows.where(done).limit(1).count():
        write_delta(rows.where(~done), out, f"settled-{settled}")
        delete_path(spark, f"{out}/{folders[0]}")
