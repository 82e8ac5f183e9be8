"""Reports on rows that break the constraints of the warehouse tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions.keys import surrogate_key
from hirelake.schemas import Table

KEY_SEPARATOR = " | "


def pk_violations(df: DataFrame, table: Table) -> DataFrame:
    """Keys that occur more than once, and keys with a NULL part, with their number of rows."""
    keys = [F.col(k) for k in table.key]
    has_null = reduce(lambda a, b: a | b, [k.isNull() for k in keys])
    shown = F.concat_ws(
        KEY_SEPARATOR, *[F.coalesce(k.cast("string"), F.lit("NULL")) for k in keys]
    )
    return (
        df.groupBy(*table.key)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(has_null | (F.col("n_rows") > 1))
        .select(
            F.lit(table.name).alias("table_name"),
            shown.alias("key_text"),
            F.when(has_null, "null key").otherwise("duplicate key").alias("reason"),
            "n_rows",
        )
    )


def unique_violations(df: DataFrame, name: str, labels: Sequence[str], pk: str) -> DataFrame:
    """Labels that several keys of a dimension share."""
    return (
        df.select(pk, *labels)
        .distinct()
        .groupBy(*labels)
        .agg(F.count(pk).alias("n_keys"))
        .where("n_keys > 1")
        .select(
            F.lit(name).alias("table_name"),
            F.concat_ws(KEY_SEPARATOR, *labels).alias("label"),
            "n_keys",
        )
    )


def fk_orphans(fact: DataFrame, references: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Foreign keys without a row in their dimension: fk_name, fk_value, n_rows.

    ``references`` gives the dimension and its key column per foreign key. All keys are counted in
    one pass over the fact; what is joined are distinct keys, on the columns they were counted by.
    """
    pairs = F.array(
        *[F.struct(F.lit(fk).alias("fk_name"), F.col(fk).cast("string").alias("fk_value")) for fk in references]
    )
    used = (
        fact.select(F.inline(pairs))
        .where("fk_value IS NOT NULL")
        .groupBy("fk_name", "fk_value")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    known = reduce(
        DataFrame.unionByName,
        [
            dim.select(F.lit(fk).alias("fk_name"), F.col(pk).cast("string").alias("fk_value"))
            for fk, (dim, pk) in references.items()
        ],
    )
    return used.join(known, ["fk_name", "fk_value"], "left_anti")


def varchar_overflow(df: DataFrame, table: Table) -> DataFrame:
    """Per limited column: rows over the limit and the longest text. One pass, one row per column."""
    limits = {name: limit for name, limit in table.limits.items() if name in df.columns}
    measures: list[Column] = []
    for name, limit in limits.items():
        length = F.length(name)
        measures += [
            F.count(F.when(length > limit, 1)).alias(f"{name}__over"),
            F.max(length).alias(f"{name}__longest"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(table.name).alias("table_name"),
                F.lit(name).alias("column_name"),
                F.lit(limit).alias("max_allowed"),
                F.col(f"{name}__over").alias("n_over"),
                F.col(f"{name}__longest").alias("longest"),
            )
            for name, limit in limits.items()
        ]
    )
    return df.agg(*measures).select(F.inline(rows))


def null_counts(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """Per column: rows without a value, of how many. One pass, one row per column."""
    measures = [F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns]
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(c).alias("column_name"),
                F.col(c).alias("n_null"),
                F.col("n__rows").alias("n_rows"),
            )
            for c in columns
        ]
    )
    return df.agg(F.count(F.lit(1)).alias("n__rows"), *measures).select(F.inline(rows))


def key_collisions(labels: DataFrame, name: str, label: str, length: int) -> DataFrame:
    """Short keys that several labels share: key_name, key_len, key, number of labels, smallest and largest."""
    return (
        labels.select(F.col(label).alias("label"))
        .where("label IS NOT NULL")
        .distinct()
        .groupBy(surrogate_key("label", length).alias("short_key"))
        .agg(
            F.count(F.lit(1)).alias("n_labels"),
            F.min("label").alias("first_label"),
            F.max("label").alias("last_label"),
        )
        .where("n_labels > 1")
        .select(
            F.lit(name).alias("key_name"),
            F.lit(length).alias("key_len"),
            "short_key",
            "n_labels",
            "first_label",
            "last_label",
        )
    )


def date_coverage(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Posting dates outside the calendar, with their number of facts."""
    used = fact.groupBy("date_posted_fk").agg(F.count(F.lit(1)).alias("n_rows"))
    days = calendar.select(F.col("date_iso_format_pk").alias("date_posted_fk"))
    return used.join(days, "date_posted_fk", "left_anti")
