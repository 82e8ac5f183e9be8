"""Mixing sources to target weights.

Every document gets a hash-random key. Within each source the documents are range-sorted by that key,
distributed prefix sums of their words find the key at which the source's budget ends, and budgets
above a source's size repeat it in whole epochs first. What is applied to the documents is one row per
source, so their texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import WORD, prefix_sums, stored, word_count

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2


def random_key(doc_id: str, seed: int) -> Column:
    """A key that looks random but is the same in every run."""
    number = F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))
    return F.md5(F.concat(F.lit(f"{seed}:"), number))


def _known(source: Column) -> Column:
    """Sorts by code point, NULL last, without being NULL itself."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """One row per source from rows of (label, size): its size and the words it is to give.

    Sources take the weights in turn, by code point with NULL last. A target stops at ``most`` times
    its source's size; what is above goes to the others by weight, until none is above. Each round of
    that is one aggregate over the sources; a round without a newly full source is the last.
    """
    sources = stored(sizes.groupBy("label").agg(F.sum("size").alias("source_size")), "sources")
    ranked = prefix_sums(sources.withColumns({"one": F.lit(1), "all": F.lit(0)}), "all", ["label"], "one", "rank")
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = stored(
        ranked.select("label", "source_size", weight.alias("weight"), (F.col("source_size") * float(most)).alias("cap")),
        "weights",
    )
    level, full = 0.0, -1
    while True:
        # Targets are weight x level; sources whose cap lies below that are full.
        is_full = F.col("cap") <= F.col("weight") * F.lit(level)
        row = ranked.agg(
            (F.sum("source_size") * share).alias("budget"),
            F.sum(F.when(is_full, F.col("cap")).otherwise(0.0)).alias("fixed"),
            F.sum(F.when(is_full, 0.0).otherwise(F.col("weight"))).alias("open"),
            F.sum(is_full.cast("long")).alias("full"),
        ).first()
        if not row["open"] or row["full"] == full:
            break
        level, full = (row["budget"] - row["fixed"]) / row["open"], row["full"]
    return ranked.select(
        "label", "source_size", F.least(F.col("cap"), F.col("weight") * F.lit(level)).alias("target")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = 42,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Adds to every document how much of it the mix takes; no row is dropped here.

    Columns: ``size`` (words; 0 for a NULL or empty text), ``source_size``, ``target`` (both of its
    source), ``taken`` (words taken, repeats counted), ``epochs`` (whole copies) and ``part_words``
    (words of one more copy). A source gives whole epochs of all its documents while its budget lasts;
    of the last epoch it gives documents in the order of their keys, and the first words of the one
    at which the budget (the target in whole words) ends.

    NULL is a source like any other. Documents that share a number share a key; where the budget ends
    among them, each gives the same share of its words. Columns of the input that have one of these
    names are replaced; others stay as they are. An empty table gives an empty table.
    """
    label = _known(F.col(source))
    sizes = stored(
        docs.select(label.alias("label"), random_key(doc_id, seed).alias("key"), word_count(text).alias("size")),
        "sizes",
    )
    budget = F.round("target").cast("long")
    targets = source_targets(sizes, weights, share, most).withColumns(
        {
            "epochs": F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0),
            "budget": budget,
        }
    )
    targets = stored(targets.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size")), "targets")
    keyed = sizes.groupBy("label", "key").agg(F.sum("size").alias("words"))
    running = prefix_sums(keyed, "label", ["key"], "words")
    last = running.join(targets.select("label", "rest"), "label").where(
        (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words"))
    )
    cuts = last.select(
        "label", F.col("key").alias("cut_key"), "words", (F.col("rest") - F.col("before")).alias("cut_words")
    )
    plan = stored(targets.join(cuts, "label", "left"), "cuts")  # one row per source
    new = ["size", "source_size", "target", "taken", "epochs", "part_words"]
    kept = [c for c in docs.columns if c.lower() not in new]
    marked = docs.select(
        F.struct(*kept).alias("_doc"), label.alias("label"), random_key(doc_id, seed).alias("key"),
        word_count(text).alias("size"),
    )
    part = (
        F.when(F.col("key") < F.col("cut_key"), F.col("size"))
        .when(F.col("key") == F.col("cut_key"), F.floor(F.col("size") * F.col("cut_words") / F.col("words")))
        .otherwise(0)
        .cast("long")
    )
    return (
        marked.join(plan, "label")
        .withColumn("part_words", part)
        .select(
            "_doc.*", "size", "source_size", "target",
            (F.col("epochs") * F.col("size") + F.col("part_words")).alias("taken"),
            F.col("epochs").cast("int").alias("epochs"), "part_words",
        )
    )


def first_words(text: Column, words: Column) -> Column:
    """The text up to the end of its ``words``-th word."""
    pieces = F.regexp_extract_all(text, F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    return F.array_join(F.slice(pieces, F.lit(1), words.cast("int")), "")


def mixed_documents(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mix as documents: each row as often as it is taken, the last one cut, columns as they were.

    Documents of which nothing is taken go. Those without words stay in every whole epoch.
    """
    plan = mix(docs, text=text, **options)
    whole, part = F.col("epochs"), F.col("part_words")
    cut = F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>"))
    takes = F.concat(F.array_repeat(F.col("size"), whole), cut)
    taken = plan.withColumn("_take", F.explode(takes))
    shortened = F.when(F.col("_take") < F.col("size"), first_words(F.col(text), F.col("_take"))).otherwise(F.col(text))
    return taken.withColumn(text, shortened).select(*docs.columns)
