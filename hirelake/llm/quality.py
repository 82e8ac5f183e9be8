"""A quality classifier on random-indexing word vectors.

Every word has a random index vector with a few entries of 1 and -1. The vector of a word is the sum of
the index vectors of the words around it, over all texts, next to its own. A document is the mean of
its words' vectors; a two-layer network makes a score of that, and a temperature, chosen on labelled
rows kept out of the training, makes the score a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.llm.common import some_rows, spare
from hirelake.llm.words import Words, hashed, letters, signs, split_words

# Words share this many vectors by hash; the table of vectors is therefore as small at any size of input.
BUCKETS, DIMENSIONS, ENTRIES, AROUND = 1 << 13, 64, 2, 2
MOST_LABELLED = 20_000  # labelled rows that the network is fitted on: those with the smallest hashes
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 20, 256, 0.01, 1e-4
CALIBRATED_ON = 0.2  # share of the labelled rows that choose the temperature
TEXT_BYTES_AT_ONCE = 1 << 20


class Network(NamedTuple):
    """Weights of both layers, the scaling of the inputs, and the temperature."""

    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.shift) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the entries of every bucket's index vector."""
    random = np.random.default_rng(BUCKETS + DIMENSIONS)
    places = random.integers(0, DIMENSIONS, (BUCKETS, ENTRIES))
    return places, random.choice([-1.0, 1.0], (BUCKETS, ENTRIES))


def streams(words: Words) -> list[np.ndarray]:
    """Buckets of every word, of the signs in it, and of its shape and whether it repeats the last one."""
    plain = letters(words.distinct)
    upper = pc.and_(pc.equal(words.distinct, pc.utf8_upper(words.distinct)), pc.greater(pc.utf8_length(plain), 1))
    title = pc.utf8_is_title(words.distinct)
    shape = np.where(upper, 2, np.where(title, 1, 0))
    code = hashed(plain, "word", BUCKETS)[words.code]
    same = np.r_[False, (code[1:] == code[:-1]) & (words.text[1:] == words.text[:-1])]
    marks = hashed(pa.array([f"{s} {r}" for r in (0, 1) for s in (0, 1, 2)]), "shape", BUCKETS)
    return [code, hashed(signs(words.distinct), "signs", BUCKETS)[words.code], marks[shape[words.code] + 3 * same]]


def _lots(batch: pa.RecordBatch, column: int = 0) -> Iterator[tuple[pa.RecordBatch, Words]]:
    for part in some_rows(batch, TEXT_BYTES_AT_ONCE):
        yield part, split_words(part.column(column))


def context_sums(docs: DataFrame, text: str = "text") -> DataFrame:
    """For each bucket how often it occurs and the sums of the index vectors around it, over all texts."""
    names = [f"d{k}" for k in range(DIMENSIONS)]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, values = index_vectors()
        sums, counts = np.zeros(BUCKETS * DIMENSIONS), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, words in _lots(batch):
                for code in streams(words):
                    counts += np.bincount(code, minlength=BUCKETS)
                    for apart in range(1, AROUND + 1):
                        near = words.text[apart:] == words.text[:-apart]
                        a, b = code[:-apart][near], code[apart:][near]
                        at = np.r_[a, b] * DIMENSIONS
                        other = np.r_[b, a]
                        for k in range(ENTRIES):
                            sums += np.bincount(at + places[other, k], values[other, k], len(sums))
        seen = np.flatnonzero(counts)
        table = sums.reshape(BUCKETS, DIMENSIONS)[seen].astype(np.int64)
        columns = [pa.array(seen), pa.array(counts[seen]), *(pa.array(c) for c in table.T)]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", "n", *names])

    schema = ", ".join(f"{c} long" for c in ["bucket", "n", *names])
    return docs.select(text).mapInArrow(summed, schema).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ["n", *names]])


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The table of vectors, ``BUCKETS`` rows: context and index vector, weighted for rare words."""
    rows = context_sums(docs, text).collect()  # at most one row for each bucket
    context, counts = np.zeros((BUCKETS, DIMENSIONS)), np.zeros(BUCKETS)
    for row in rows:
        counts[row[0]], context[row[0]] = row[1], row[2:]
    total = max(counts.sum(), 1.0)
    # What all words have in common says nothing about one of them.
    context -= np.outer(counts, context.sum(axis=0) / total)
    context /= np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1e-9)
    places, values = index_vectors()
    index = np.zeros((BUCKETS, DIMENSIONS))
    for k in range(ENTRIES):
        np.add.at(index, (np.arange(BUCKETS), places[:, k]), values[:, k])
    weight = 1 / (1 + counts / total * 1e3) ** 0.5
    return (np.hstack([context * weight[:, None], index]) / np.sqrt(ENTRIES)).astype(np.float32)


def pooled(words: Words, vectors: np.ndarray) -> np.ndarray:
    """One row per text: means of the vectors of its words, of their signs and of their shapes."""
    counts = np.bincount(words.text, minlength=words.texts)
    per_word = np.maximum(counts, 1)[:, None]
    found = []
    for code in streams(words):
        total = np.zeros((words.texts, vectors.shape[1]), np.float32)
        distinct, place = np.unique(code, return_inverse=True)
        if len(distinct) * words.texts <= len(code):  # few different ones: count them
            counted = np.bincount(words.text * len(distinct) + place, minlength=words.texts * len(distinct))
            total = counted.reshape(words.texts, -1).astype(np.float32) @ vectors[distinct]
        elif len(code):
            starts = np.flatnonzero(np.r_[True, words.text[1:] != words.text[:-1]])
            total[words.text[starts]] = np.add.reduceat(vectors[code], starts, axis=0)
        found.append(total / per_word)
    return np.hstack([*found, np.log1p(counts)[:, None]]).astype(np.float32)


def fit(x: np.ndarray, y: np.ndarray, seed: int = 7) -> Network:
    """Trains by Adam on cross-entropy; labels of one kind only, or none, give their share as score."""
    width = x.shape[1]
    base = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    none = Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), float(np.log(base / (1 - base))), 1.0)
    if len(y) < 10 or y.min() == y.max():
        return none
    random = np.random.default_rng(seed)
    order = random.permutation(len(y))
    held, used = np.split(order, [int(len(y) * CALIBRATED_ON)])
    shift, scale = x[used].mean(axis=0), x[used].std(axis=0) + 1e-3
    z = (x - shift) / scale
    state = [random.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN), random.normal(0, HIDDEN**-0.5, HIDDEN), np.array(none.b2)]
    first, second = [np.zeros_like(p) for p in state], [np.zeros_like(p) for p in state]
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / EPOCHS))
        random.shuffle(used)
        for at in range(0, len(used), BATCH):
            rows = used[at : at + BATCH]
            hidden = np.tanh(z[rows] @ state[0] + state[1])
            error = (1 / (1 + np.exp(-np.clip(hidden @ state[2] + state[3], -30, 30))) - y[rows]) / len(rows)
            back = error[:, None] * state[2] * (1 - hidden**2)
            step += 1
            for k, g in enumerate([z[rows].T @ back, back.sum(axis=0), hidden.T @ error, error.sum()]):
                g = g + DECAY * state[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                state[k] = state[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    fitted = Network(shift, scale, state[0], state[1], state[2], float(state[3]), 1.0)
    logits, truth = fitted.logits(x[held]), y[held]
    temperatures = np.exp(np.linspace(-1.5, 3, 91))
    losses = [np.mean(np.logaddexp(0, logits / t) - truth * logits / t) for t in temperatures]
    return fitted._replace(temperature=float(temperatures[int(np.argmin(losses))]))


def labelled_sample(labels: DataFrame, label: str, doc_id: str = "doc_id", most: int = MOST_LABELLED) -> DataFrame:
    """(doc_id, label) of at most ``most`` labelled rows: those with the smallest hashes of the number."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    one = known.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(most)


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
    most: int = MOST_LABELLED,
) -> tuple[np.ndarray, Network]:
    """Word vectors from all texts, and the network from at most ``most`` of the labelled ones."""
    vectors = word_vectors(docs, text)
    broadcast = docs.sparkSession.sparkContext.broadcast(vectors)
    sample = labelled_sample(labels, label, most=most)
    # The sample is bounded, so it may be broadcast; the texts stay where they are.
    known = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).join(
        F.broadcast(sample), "doc_id"
    )

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, words in _lots(batch, 1):
                rows = [r.astype("<f4").tobytes() for r in pooled(words, broadcast.value)]
                columns = [part.column(0), part.column(2), pa.array(rows, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "x"])

    rows = known.mapInArrow(featured, "doc_id long, label int, x binary").dropDuplicates(["doc_id"]).collect()
    rows.sort(key=lambda r: r["doc_id"])
    width = 3 * vectors.shape[1] + 1
    x = np.array([np.frombuffer(r["x"], "<f4") for r in rows], np.float32).reshape(len(rows), width)
    y = np.array([float(r["label"] == 1) for r in rows])
    return vectors, fit(x, y)


def with_quality(
    docs: DataFrame,
    vectors: np.ndarray,
    network: Network,
    text: str = "text",
    name: str = "score",
    threshold: float = 0.3,
    keep_text: bool = True,
) -> DataFrame:
    """Adds the probability that a text is good, and ``predicted``: 1 from ``threshold`` on.

    The whole text counts, and nothing else. A NULL or empty text has no words: its vector is zero,
    and it gets the network's answer to that. Columns of these names are replaced; repeated rows get
    equal scores; no rows give no rows.
    """
    kept = [c for c in docs.columns if c.lower() not in (name, "predicted") and (keep_text or c != text)]
    scored, inner = [*kept, name], spare([*kept, name], "scored_text")
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(name, T.DoubleType())])
    model = docs.sparkSession.sparkContext.broadcast((vectors, network))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, network = model.value
        for batch in batches:
            for part, words in _lots(batch, batch.num_columns - 1):
                found = network.probabilities(pooled(words, vectors).astype(np.float64))
                columns = [*part.columns[:-1], pa.array(found, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, scored)

    result = docs.select(*kept, F.col(text).alias(inner)).mapInArrow(score, schema)
    return result.withColumn("predicted", (F.col(name) >= threshold).cast("int"))
