import math

import numpy as np
import pytest

from hirelake.llm import whitening
from hirelake.llm.queries import QUERIES
from tests.llm.conftest import FOLDER


def brute(vectors):
    """Whole numbers of usable vectors, and mean, eigenvalues and eigenvectors of the distinct ones."""
    good = [v for v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in good], np.int64)
    fit = np.unique(x, axis=0)
    mean = fit.sum(axis=0) / len(fit)
    values, components = np.linalg.eigh((fit - mean).T @ (fit - mean) / len(fit))
    return x, fit, mean, values[::-1], components[:, ::-1]


def same_up_to_sign(a, b):
    return min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-6


@pytest.mark.parametrize("size", [1, 2, 3, 16, 64, 150])
@pytest.mark.parametrize("spectrum", ["flat", "steep", "singular", "repeated"])
def test_components(size, spectrum):
    draw = np.random.default_rng(size)
    values = {
        "flat": 1 + draw.random(size),
        "steep": 10.0 ** -np.linspace(0, 12, size),
        "singular": np.where(np.arange(size) % 3 == 0, 0, 1 + draw.random(size)),
        "repeated": np.repeat([3.0, 2.0, 1.0], size)[:: 3][:size],
    }[spectrum]
    basis, _ = np.linalg.qr(draw.normal(size=(size, size)))
    matrix = basis * values @ basis.T
    found, vectors = whitening.spectral_components(matrix)
    scale = values.max(initial=1)
    assert np.abs(found - np.sort(values)[::-1]).max() < 1e-13 * size * scale
    assert np.abs(vectors.T @ vectors - np.eye(size)).max() < 1e-12
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-12 * scale * size


def test_polar_factor():
    draw = np.random.default_rng(3)
    matrix = draw.normal(size=(20, 20))
    u, _, v = np.linalg.svd(matrix)
    assert np.abs(whitening.polar_factor(matrix) - u @ v).max() < 1e-12


def check(rows, vectors, distinct_values=True):
    x, fit, mean, values, components = brute(vectors)
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    table = {}
    for row in rows:
        table.setdefault(row["vec_id"], {})[row["component"]] = row
    size = min(16, x.shape[1], int((values > 1e-9 * values[0]).sum()))
    by_component = [np.array([table[k][c]["whitened"] for k in sorted(table)]) for c in range(1, size + 1)]
    for c in range(size):
        if distinct_values:
            assert same_up_to_sign(by_component[c], (x - mean) @ components[:, c] / np.sqrt(values[c]))
    for k, numbers in zip(sorted(table), x.tolist()):
        assert sorted(table[k]) == list(range(1, size + 1))
        for c, row in table[k].items():
            assert row["n"] == n
            assert row["deviation"] == sum((n * v - s) ** 2 for v, s in zip(numbers, sums))
            assert row["explained"] == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)
            assert row["identity_error"] < 1e-9


def test_query(spark, given):
    vectors = [r["embedding"] for r in given("embeddings").orderBy("vec_id").collect()]
    check(QUERIES["op12_embedding_whitening"](spark, FOLDER).collect(), vectors)


def test_odd_vectors(spark, tmp_path):
    draw = np.random.default_rng(4)
    vectors = [[float(c) for c in v] for v in draw.normal(size=(60, 5)) * [5, 4, 3, 2, 1]]
    odd = [None, [1.0, None, 1.0, 1.0, 1.0], [float("nan")] * 5, [1.0, float("inf"), 0.0, 0.0, 0.0]]
    vectors += [vectors[0]] * 40 + odd + [[0.0] * 5]
    rows = [(k, v, "extra", 1) for k, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string, deviation int")
    table.write.parquet(f"{tmp_path}/embeddings.parquet")
    check(QUERIES["op12_embedding_whitening"](spark, str(tmp_path)).collect(), vectors)
    result, model = whitening.whitened(table)
    assert set(result.columns) == {"vec_id", "x", "whitened", "deviation"} and result.count() == 101
    assert model.n == 61


@pytest.mark.parametrize("vectors", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 3, [[]]])
def test_nothing_to_whiten(spark, tmp_path, vectors):
    table = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>")
    table.write.parquet(f"{tmp_path}/embeddings.parquet")
    assert QUERIES["op12_embedding_whitening"](spark, str(tmp_path)).collect() == []


def test_lengths_and_large_entries(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0]), (3, [3.0, 0.0]), (4, [1e300, -1e300]), (None, [0.5, 0.25])]
    result, model = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = {r["vec_id"]: r for r in result.collect()}
    assert model.n == 5 and found[4]["deviation"] is None and len(found[1]["whitened"]) >= 1
