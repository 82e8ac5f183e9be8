"""Choosing a category from scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def score_map(scores: Mapping[str, Column]) -> Column:
    """A map column from label to score."""
    pairs = [part for label, score in scores.items() for part in (F.lit(label), score)]
    return F.create_map(*pairs)


def argmax_category(scores: Column, labels: Sequence[str]) -> Column:
    """The label with the highest score in a map column; the first label in order wins a tie."""
    ranked = F.array(
        *[
            F.struct(
                F.try_element_at(scores, F.lit(label)).cast("double").alias("score"),
                F.lit(-position).alias("rank"),
                F.lit(label).alias("label"),
            )
            for position, label in enumerate(labels)
        ]
    )
    best = F.array_max(F.filter(ranked, lambda s: s["score"].isNotNull()))
    return best["label"]


def marker_count(text: Column, markers: Sequence[str]) -> Column:
    """How many words (runs of letters) of a text are one of the marker words; NULL without a text."""
    words = "|".join(sorted(markers, key=lambda m: (-len(m), m)))
    return F.regexp_count(text, F.lit(rf"(?<!\p{{L}})(?:{words})(?!\p{{L}})")).cast("bigint")


def hash_bucket(key: Column, buckets: int) -> Column:
    """A bucket that depends on the key alone, from the first 32 bits of its MD5."""
    leading = F.conv(F.left(F.md5(key.cast("string")), F.lit(8)), 16, 10).cast("bigint")
    return F.pmod(leading, F.lit(buckets)).cast("int")
