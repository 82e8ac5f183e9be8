"""Constraints enforced on write: what keeps them is accepted, the rest goes to quarantine with its reasons.

All checks are columns of one pass over the incoming rows: NULL keys, NOT NULL columns, length limits and
foreign keys, the latter by joins with the keys of the dimensions. Accepted and rejected rows are two
partitions of one version of the table, written by one job and made current by one rename.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hirelake.operators import versions
from hirelake.schemas import Table

ACCEPTED, REASONS = "accepted", "reasons"
References = Mapping[str, tuple[DataFrame, str]]


class Outcome(NamedTuple):
    version: int
    incoming: int
    accepted: int


def _known(fk: str) -> str:
    return f"_known_{fk}"


def _reasons(table: Table, columns: Sequence[str], references: Sequence[str]) -> list[Column]:
    """A text for each broken rule, NULL for each that is kept."""
    found = [F.when(F.col(k).isNull(), f"null key: {k}") for k in table.key]
    found += [F.when(F.col(c).isNull(), f"no value: {c}") for c in table.not_null if c not in table.key]
    found += [F.when(F.length(c) > most, f"too long: {c}") for c, most in table.limits.items() if c in columns]
    return found + [F.when(F.col(fk).isNotNull() & F.col(_known(fk)).isNull(), f"no such key: {fk}") for fk in references]


def checked(rows: DataFrame, table: Table, references: References | None = None, newest: Sequence[Column] = ()) -> DataFrame:
    """The rows with ``reasons`` (a list, empty if all rules are kept) and ``accepted``.

    ``references`` gives a dimension and its key column for each foreign key; a NULL refers to nothing and
    breaks no reference. With ``newest``, columns that order the rows of a key and tell them apart, all but
    the greatest of a key are refused as duplicates; the greatest is an aggregate, so a key with most of
    the rows is reduced before it is shuffled.
    """
    references = dict(references or {})
    joined = rows
    for fk, (dimension, pk) in references.items():
        keys = dimension.select(F.col(pk).alias(fk), F.lit(True).alias(_known(fk))).where(F.col(fk).isNotNull()).distinct()
        joined = joined.join(keys, fk, "left")
    reasons = _reasons(table, rows.columns, list(references))
    if newest:
        rank = F.struct(*newest)
        best = rows.dropna(subset=list(table.key)).groupBy(*table.key).agg(F.max(rank).alias("_best"))
        joined = joined.join(best, list(table.key), "left")
        reasons.append(F.when(F.col("_best").isNotNull() & (rank != F.col("_best")), "duplicate key"))
    broken = F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
    return joined.select(*[F.col(c) for c in rows.columns], broken.alias(REASONS)).withColumn(ACCEPTED, F.size(REASONS) == 0)


def write_enforced(
    spark: SparkSession,
    rows: DataFrame,
    table: Table,
    path: str,
    references: References | None = None,
    newest: Sequence[Column] = (),
) -> Outcome:
    """Checks and writes the rows as the next version at ``path``, and counts them on the way.

    Every row is written once: ``accepted_rows`` and ``quarantined_rows`` read their part only.
    """
    counts = Observation()
    observed = checked(rows, table, references, newest).observe(
        counts, F.count(F.lit(1)).alias("incoming"), F.count(F.when(F.col(ACCEPTED), 1)).alias("accepted")
    )
    version = versions.publish(spark, observed, path, partition=ACCEPTED)
    return Outcome(version, counts.get["incoming"], counts.get["accepted"])


def accepted_rows(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return versions.read_version(spark, path, version).where(F.col(ACCEPTED)).drop(ACCEPTED, REASONS)


def quarantined_rows(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """What was refused, with its reasons: to be mended and written again."""
    return versions.read_version(spark, path, version).where(~F.col(ACCEPTED)).drop(ACCEPTED)
