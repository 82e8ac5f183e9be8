import zlib

import numpy as np
import pyarrow as pa
import pytest

from hirelake.llm import quality, toxicity
from hirelake.llm.queries import QUERIES
from hirelake.llm.words import hashed, letters, signs, split_words

from .conftest import FOLDER

LARGER = "/root/testdata/sf0.01"


def area(scores, truth):
    """Share of pairs of a positive and a negative row that are in order."""
    a, b = scores[truth == 1], scores[truth == 0]
    return float(np.mean((a[:, None] > b[None]) + 0.5 * (a[:, None] == b[None])))


def test_words():
    words = split_words(pa.array(["Ab, c  ab!", None, "", " x\n"]))
    assert [words.distinct[c].as_py() for c in words.code] == ["Ab,", "c", "ab!", "x"]
    assert words.text.tolist() == [0, 0, 0, 3] and words.texts == 4
    assert letters(pa.array(["Ab,", "É1"])).to_pylist() == ["ab", "é1"]
    assert signs(pa.array(["Ab,", "$$$", "x"])).to_pylist() == [",", "$$$", ""]
    assert hashed(pa.array(["a", "b", "a"]), "k", 1000)[0] == hashed(pa.array(["a"]), "k", 1000)[0]
    assert len(split_words(pa.array([], pa.string())).code) == 0


def test_context_sums_equal_brute_force(spark, rows):
    texts = ["a b c a b", "c, d a", "", "a"]
    docs = rows("doc_id long, text string", *enumerate(texts), (9, None))
    found = {r["bucket"]: (r["n"], [r[f"d{k}"] for k in range(quality.DIMENSIONS)]) for r in quality.context_sums(docs).collect()}
    places, values = quality.index_vectors()
    sums, counts = np.zeros((quality.BUCKETS, quality.DIMENSIONS)), np.zeros(quality.BUCKETS)
    for text in texts:
        for stream in quality.streams(split_words(pa.array([text]))):
            for i, a in enumerate(stream):
                counts[a] += 1
                for j, b in enumerate(stream):
                    if i != j and abs(i - j) <= quality.AROUND:
                        for k in range(quality.ENTRIES):
                            sums[a, places[b, k]] += values[b, k]
    assert set(found) == set(np.flatnonzero(counts).tolist())
    for bucket, (n, vector) in found.items():
        assert n == counts[bucket] and vector == sums[bucket].tolist()


def test_pooled_is_the_mean_of_word_vectors():
    vectors = np.random.default_rng(0).normal(size=(quality.BUCKETS, 6)).astype(np.float32)
    texts = ["one two, three two", "", "x"] + ["the same words again and again " * 30] * 40
    words = split_words(pa.array(texts))
    found = quality.pooled(words, vectors)
    parts = quality.streams(words)
    for k in range(len(texts)):
        own = words.text == k
        wanted = np.hstack([vectors[s[own]].mean(axis=0) if own.any() else np.zeros(6) for s in parts])
        assert np.allclose(found[k, :-1], wanted, atol=1e-5)
        assert np.isclose(found[k, -1], np.log1p(own.sum()))


def test_network_learns_and_is_calibrated():
    random = np.random.default_rng(2)
    x = random.normal(size=(4000, 5))
    chance = 1 / (1 + np.exp(-2 * x[:, 0] * x[:, 1]))  # not linear
    y = (random.random(4000) < chance).astype(float)
    p = quality.fit(x, y).probabilities(x)
    assert area(p, y) > 0.75
    for low, high in ((0.1, 0.4), (0.6, 0.9)):
        some = (p > low) & (p < high)
        assert abs(p[some].mean() - y[some].mean()) < 0.1


@pytest.mark.parametrize("y", [[], [1.0] * 20, [0.0] * 20, [1.0, 0.0]])
def test_few_or_equal_labels(y):
    p = quality.fit(np.zeros((len(y), 3)), np.array(y)).probabilities(np.zeros((2, 3)))
    assert ((p > 0) & (p < 1)).all()


def test_quality_query(spark, duck):
    found = QUERIES["op6_quality_classifier"](spark, LARGER).toPandas()
    labels = duck.execute(f"SELECT doc_id, quality FROM '{LARGER}/labels.parquet'").df()
    assert found.columns.tolist() == ["doc_id", "held_out", "score", "predicted"]
    assert all(h == (zlib.crc32(str(d).encode()) % 5 == 0) for d, h in zip(found.doc_id, found.held_out))
    assert ((found.score >= 0) & (found.score <= 1)).all()
    assert ((found.score >= 0.3) == (found.predicted == 1)).all()
    held = found[found.held_out].merge(labels, on="doc_id")
    assert area(held.score.to_numpy(), held.quality.to_numpy()) > 0.95
    assert (held.predicted[held.quality == 1] == 1).mean() > 0.95


def test_toxicity_query(spark, duck):
    found = QUERIES["op8_toxicity"](spark, "/root/testdata/sf0.1").toPandas()
    labels = duck.execute("SELECT doc_id, toxic FROM '/root/testdata/sf0.1/labels.parquet'").df()
    assert found.columns.tolist() == ["doc_id", "held_out", "score", "predicted"]
    assert all(h == (zlib.crc32(str(d).encode()) % 4 == 2) for d, h in zip(found.doc_id, found.held_out))
    assert ((found.score >= 0) & (found.score <= 1)).all()
    held = found[found.held_out].merge(labels, on="doc_id")
    assert area(held.score.to_numpy(), held.toxic.to_numpy()) > 0.9
    assert (held.predicted[held.toxic == 1] == 1).mean() > 0.85
    assert (held.predicted[held.toxic == 0] == 0).mean() > 0.93


def test_non_negative_risk_on_simulated_data():
    """Three in ten unlabelled rows are positive; feature 0 marks them, feature 1 is everywhere."""
    random = np.random.default_rng(4)
    n_p, n_u, prior = 300, 3000, 0.3
    hidden = random.random(n_u) < prior
    marked = np.r_[random.random(n_p) < 0.9, np.where(hidden, random.random(n_u) < 0.9, random.random(n_u) < 0.02)]
    rows = n_p + n_u
    text = np.r_[np.arange(rows), np.flatnonzero(marked)]
    feature = np.r_[np.ones(rows, int), np.zeros(marked.sum(), int)]
    positive = np.r_[np.ones(n_p, int), np.zeros(n_u, int)]
    w, b = toxicity.train_pu(rows, text, feature, positive, prior, 2, 0)
    scores = toxicity.Model(np.arange(2), w[None], np.array([b])).probabilities(rows, text, feature)[n_p:]
    assert area(scores, hidden.astype(int)) > 0.9
    assert abs((scores >= 0.5).mean() - marked[n_p:].mean()) < 0.02


def test_features_are_words_and_stems():
    buckets = np.sort(hashed(pa.array(["idiot"]), "word", toxicity.BUCKETS))
    text, place = toxicity.features(split_words(pa.array(["An IDIOT! idiot", "nothing", None])), buckets)
    assert (text.tolist(), place.tolist()) == ([0], [0])
    text, _ = toxicity.features(split_words(pa.array(["abcdefg", "ab", ""])))
    assert np.bincount(text).tolist() == [5, 1]
    assert len(toxicity.features(split_words(pa.array(["a b"])), np.empty(0, np.int64))[0]) == 0


def test_odd_tables(odd, none, clashing, rows):
    labels = rows("doc_id long, quality int, toxic int", (1, 1, 0), (4, 0, 1), (4, 0, 1), (None, 1, 1), (5, None, None), (77, 1, 1))
    for docs in (odd, none, clashing):
        model = quality.train(docs, labels)
        scored = quality.with_quality(docs, *model)
        assert scored.count() == docs.count()
        assert all(0 <= r["score"] <= 1 for r in scored.collect())
        found = toxicity.with_toxicity(docs, toxicity.train(docs, labels))
        assert found.count() == docs.count()
        assert all(0 <= r["score"] <= 1 for r in found.collect())
    equal = [r["score"] for r in quality.with_quality(odd, *quality.train(odd, labels)).where("doc_id = 5").collect()]
    assert equal[0] == equal[1]
    no_labels = labels.where("false")
    assert quality.with_quality(odd, *quality.train(odd, no_labels)).first()["score"] == 0.5
    assert toxicity.train(odd, no_labels).probabilities(1, np.empty(0, int), np.empty(0, int))[0] == pytest.approx(0.1)
