"""A training corpus from raw documents: five stages, each one operator of hirelake.llm.

All stages take a NULL text for an empty one and texts of any length whole, treat repeated rows as rows
of their own, keep columns whatever their names, and give an empty table for an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hirelake.llm import mixing, packing, quality, simhash, toxicity
from hirelake.llm.common import read_table, stored

SCORE = "score"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go.

    Every row is scored by its text alone, so empty texts and equal ones are treated alike. Rows without a
    number can't be labelled, but are scored.
    """
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.with_toxicity(docs, model, name=SCORE).where("predicted = 0").select(*docs.columns)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    Every row is scored by its text alone; rows without a number are scored, not learnt from.
    """
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.with_quality(docs, *model, name=SCORE).where("predicted = 1").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest number.

    Fingerprints of four-word shingles link at four or fewer differing bits. All texts without words are one
    group, and so are repeated rows; a row without a number stays only if nothing it is linked with has one.
    """
    return simhash.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, cut or left out so that sources come near their target weights.

    Rows without a source are a source of their own. Texts without words stay in every whole epoch.
    """
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of one length.

    An empty text is its end mark alone; a very long one is cut over several sequences.
    """
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_classifier", drop_low_quality),
    ("simhash_near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# The classifiers are trained and a fingerprint isn't SQL's; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written and read by the next stage."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
