"""Toxicity from confirmed toxic examples and unlabelled text, by non-negative PU learning.

No text has to be confirmed as harmless. The risk of a classifier on harmless text is estimated from the
unlabelled texts, minus what the toxic ones among them (the class prior) contribute; that estimate can't
truly be negative, so a step that would push it below zero goes the other way.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.llm.common import some_rows, spare
from hirelake.llm.words import Words, hashed, letters, split_words

BUCKETS = 1 << 40  # hashes of features; so many that a clash with a chosen one is unlikely
STEMS = (3, 4, 5, 6)  # first letters of a word that are features as well as the word
MOST_POSITIVE, MOST_UNLABELLED = 10_000, 20_000  # texts that are trained on: those with the smallest hashes
FEATURES, LEAST_POSITIVE, LEAST_PRECISION, LEAST_Z = 4096, 4, 0.55, 5.0
CLASSIFIERS, STEPS, RATE, DECAY, SLACK = 3, 1000, 0.05, 1e-6, 0.0
SIGNATURES = 3
TEXT_BYTES_AT_ONCE = 1 << 22


class Model(NamedTuple):
    """Buckets that are features, in ascending order, and the weights of every classifier."""

    buckets: np.ndarray
    weights: np.ndarray  # one row per classifier
    biases: np.ndarray

    def probabilities(self, texts: int, text: np.ndarray, feature: np.ndarray) -> np.ndarray:
        found = np.zeros(texts)
        for weights, bias in zip(self.weights, self.biases):
            logits = bias + np.bincount(text, weights[feature], texts)
            found += 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
        return found / max(len(self.biases), 1)


def features(words: Words, buckets: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) once each: words and stems that occur, as buckets or as places in ``buckets``."""
    plain = letters(words.distinct)
    size = pc.utf8_length(plain).to_numpy(zero_copy_only=False)
    kinds = [(hashed(plain, "word", BUCKETS), size > 0)]
    kinds += [(hashed(pc.utf8_slice_codeunits(plain, 0, n), f"stem{n}", BUCKETS), size > n) for n in STEMS]
    texts, found = [], []
    for bucket, real in kinds:
        if buckets is not None and len(buckets):
            place = np.minimum(np.searchsorted(buckets, bucket), len(buckets) - 1)
            real, bucket = real & (buckets[place] == bucket), place
        elif buckets is not None:
            real = np.zeros(len(bucket), bool)
        used = real[words.code]
        texts.append(words.text[used])
        found.append(bucket[words.code[used]])
    both = np.unique(np.concatenate(texts).astype(np.int64) * BUCKETS + np.concatenate(found))
    return both // BUCKETS, both % BUCKETS


def _lots(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, Words]]:
    for part in some_rows(batch, TEXT_BYTES_AT_ONCE):
        yield part, split_words(part.column(column))


def training_texts(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    doc_id: str = "doc_id",
    text: str = "text",
    usable: Column | None = None,
    most_positive: int = MOST_POSITIVE,
    most_unlabelled: int = MOST_UNLABELLED,
) -> DataFrame:
    """(doc_id, positive, text) of confirmed toxic texts and of texts taken as unlabelled.

    Both are bounded: those with the smallest hashes of their numbers. ``usable`` tells which numbers
    may be used at all. A confirmed text may be among the unlabelled ones too, as in any such sample.
    Of copies one is taken, or else their words would look like marks of toxicity.
    """
    numbers = docs.select(F.col(doc_id).cast("long").alias("doc_id")).where("doc_id IS NOT NULL")
    numbers = numbers if usable is None else numbers.where(usable)
    toxic = labels.where(F.col(label) == 1).select(F.col("doc_id").cast("long").alias("doc_id"))
    toxic = toxic.where("doc_id IS NOT NULL")

    def least(rows: DataFrame, most: int, positive: int) -> DataFrame:
        chosen = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        return chosen.select("doc_id", F.lit(positive).alias("positive"))

    sample = least(toxic, most_positive, 1).unionByName(least(numbers, most_unlabelled, 0)).distinct()
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    known = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "positive", "text")
    signed = known.mapInArrow(_signed, "doc_id long, positive int, text string, signature binary")
    return signed.dropDuplicates(["positive", "signature"]).drop("signature")


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the smallest of three hashes over a text's words: nearly always the same in its copies."""
    odd = np.random.default_rng(SIGNATURES).integers(1, 1 << 40, SIGNATURES) * 2 + 1
    for batch in batches:
        for part, words in _lots(batch, 2):
            least = np.full((words.texts, SIGNATURES), -1, np.int64)
            if len(words.code):
                starts = np.flatnonzero(np.r_[True, words.text[1:] != words.text[:-1]])
                base = hashed(letters(words.distinct), "word", BUCKETS)
                for k, factor in enumerate(odd):
                    mixed = (base * factor >> 20) & (1 << 40) - 1
                    least[words.text[starts], k] = np.minimum.reduceat(mixed[words.code], starts)
            signatures = pa.array([r.tobytes() for r in least], pa.binary())
            yield pa.RecordBatch.from_arrays([*part.columns, signatures], ["doc_id", "positive", "text", "signature"])


def class_prior(labels: DataFrame, label: str = "toxic") -> float:
    """Share of toxic rows among the labelled ones; one in ten if none is labelled, or all are toxic."""
    row = labels.where(F.col(label).isNotNull()).agg(F.avg((F.col(label) == 1).cast("double")).alias("p")).first()
    return row["p"] if row["p"] is not None and row["p"] < 1 else 0.1


def chosen_buckets(sample: DataFrame, prior: float) -> np.ndarray:
    """Buckets of which, by the class prior, most texts are toxic, and not by chance.

    The clearest ``FEATURES`` of them; the others would only add the noise of long texts.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, words in _lots(batch, 1):
                text, bucket = features(words)
                positive = part.column(0).to_numpy(zero_copy_only=False)[text]
                for kind in (0, 1):  # counted here first: few rows per task are left
                    which, n = np.unique(bucket[positive == kind], return_counts=True)
                    columns = [pa.array(which), pa.array(n * (kind == 1)), pa.array(n * (kind == 0))]
                    yield pa.RecordBatch.from_arrays(columns, ["bucket", "toxic", "other"])

    counts = sample.select("positive", "text").mapInArrow(listed, "bucket long, toxic long, other long")
    sums = counts.groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    totals = sample.agg(
        F.greatest(F.sum("positive"), F.lit(1)).alias("p"), F.greatest(F.sum(1 - F.col("positive")), F.lit(1)).alias("u")
    ).first()
    p, u = F.lit(float(totals["p"] or 1)), F.lit(float(totals["u"] or 1))
    share, rest = F.col("toxic") / p, (F.col("other") + 0.5) / u
    z = (share - rest) / F.sqrt(rest * (1 / p + 1 / u))
    clear = sums.where((F.col("toxic") >= LEAST_POSITIVE) & (z > LEAST_Z) & (share * prior > LEAST_PRECISION * rest))
    clear = clear.orderBy(z.desc(), "bucket").limit(FEATURES)
    return np.array(sorted(r["bucket"] for r in clear.select("bucket").collect()), np.int64)


def train_pu(
    rows: int, text: np.ndarray, feature: np.ndarray, positive: np.ndarray, prior: float, width: int, seed: int
) -> tuple[np.ndarray, float]:
    """Weights that minimise the non-negative risk with logistic loss, by Adam on all rows, and the bias
    at which the unlabelled rows' mean probability is the prior."""
    random = np.random.default_rng(seed)
    weights, bias = random.normal(0, 0.01, width), np.log(prior / (1 - prior))
    moments = [np.zeros(width + 1), np.zeros(width + 1)]
    p, u = positive == 1, positive == 0
    n_p, n_u = max(p.sum(), 1), max(u.sum(), 1)
    for step in range(1, STEPS + 1):
        logits = bias + np.bincount(text, weights[feature], rows)
        chance = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
        loss_as_negative = np.logaddexp(0, logits)
        negative_risk = loss_as_negative[u].sum() / n_u - prior * loss_as_negative[p].sum() / n_p
        # Slopes of both parts of the risk by logit: toxic rows as toxic, and the harmless part.
        toxic_part = np.where(p, -prior * (1 - chance) / n_p, 0.0)
        harmless_part = np.where(u, chance / n_u, -prior * chance / n_p)
        slope = toxic_part + harmless_part if negative_risk >= -SLACK else -harmless_part
        gradient = np.append(np.bincount(feature, slope[text], width) + DECAY * weights, slope.sum())
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.999 * moments[1] + 0.001 * gradient**2
        change = RATE * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.999**step)) + 1e-10)
        weights, bias = weights - change[:-1], bias - change[-1]
    # The unlabelled texts are toxic at the rate of the prior: the bias is moved until they seem so.
    logits = np.bincount(text, weights[feature], rows)[u]
    low, high = -30.0, 30.0
    for _ in range(60 if len(logits) else 0):
        bias = (low + high) / 2
        mean = (1 / (1 + np.exp(-np.clip(logits + bias, -30, 30)))).mean()
        low, high = (bias, high) if mean < prior else (low, bias)
    return weights, float(bias)


def train(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", prior: float | None = None, **sampling
) -> Model:
    """Fits the classifiers. Without a confirmed toxic text every text gets the prior as score.

    Each classifier sees all confirmed texts and a third of the unlabelled ones.
    """
    prior = min(max(class_prior(labels, label) if prior is None else prior, 1e-3), 0.9)
    sample = training_texts(docs, labels, label, **sampling)
    buckets = chosen_buckets(sample, prior)
    none = Model(buckets, np.zeros((1, max(len(buckets), 1))), np.array([np.log(prior / (1 - prior))]))
    if not len(buckets):
        return none
    known = docs.sparkSession.sparkContext.broadcast(buckets)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, words in _lots(batch, 2):
                text, place = features(words, known.value)
                bounds = np.searchsorted(text, np.arange(part.num_rows + 1))
                found = [place[a:b].astype("<i4").tobytes() for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(found, pa.binary())], ["doc_id", "positive", "x"]
                )

    rows = sample.mapInArrow(listed, "doc_id long, positive int, x binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["positive"]))
    lists = [np.frombuffer(r["x"], "<i4") for r in rows]
    positive = np.array([r["positive"] for r in rows])
    weights, biases = [], []
    for k in range(CLASSIFIERS):
        used = np.flatnonzero((positive == 1) | (np.arange(len(rows)) % CLASSIFIERS == k))
        text = np.repeat(np.arange(len(used)), [len(lists[i]) for i in used])
        feature = np.concatenate([lists[i] for i in used]) if len(used) else np.empty(0, np.int64)
        w, b = train_pu(len(used), text, feature, positive[used], prior, len(buckets), seed=k)
        weights.append(w)
        biases.append(b)
    return Model(buckets, np.array(weights), np.array(biases))


def with_toxicity(
    docs: DataFrame,
    model: Model,
    text: str = "text",
    name: str = "score",
    threshold: float = 0.3,
    keep_text: bool = True,
) -> DataFrame:
    """Adds the probability that a text is toxic, and ``predicted``: 1 from ``threshold`` on.

    The whole text counts, and nothing else. A NULL or empty text has no feature and the lowest score
    that texts get. Columns of these names are replaced; repeated rows get equal scores; no rows give
    no rows.
    """
    kept = [c for c in docs.columns if c.lower() not in (name, "predicted") and (keep_text or c != text)]
    scored, inner = [*kept, name], spare([*kept, name], "scored_text")
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(name, T.DoubleType())])
    known = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, words in _lots(batch, batch.num_columns - 1):
                found = known.value.probabilities(part.num_rows, *features(words, known.value.buckets))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found)], scored)

    result = docs.select(*kept, F.col(text).alias(inner)).mapInArrow(score, schema)
    return result.withColumn("predicted", (F.col(name) >= threshold).cast("int"))
