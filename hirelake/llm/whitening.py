"""Whitening of vectors by spectral divide and conquer.

One job sums the vectors, one the products of what is left without the mean; what reaches the driver has
the size of a covariance matrix, whatever the number of rows. There the matrix is split: shifted to its
middle, its polar decomposition (by QDWH iterations) is the matrix of signs of its eigenvalues; half the
sum with the identity projects to those above the shift. Bases of that space and of the rest give two
smaller matrices, which are split in turn until one component is left. The components go to all tasks,
which project the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.llm.common import some_rows, spare, stored

SCALE, OFFSET = 64, 1_000_000
# Larger entries count as this; up to here a scaled entry is exact in a double.
LARGEST = 1 << 52
COMPONENTS = 16
EPS = np.finfo(float).eps


# --- the decomposition of one symmetric matrix ---


def polar_factor(matrix: np.ndarray) -> np.ndarray:
    """The orthogonal factor of a square matrix by QR-based dynamically weighted Halley iterations."""
    size = len(matrix)
    norm = np.linalg.norm(matrix, 2)
    if not norm:
        return np.eye(size)
    x, identity = matrix / norm, np.eye(size)
    # Lower bound of the singular values; one that is too small only costs iterations.
    low = max(np.linalg.norm(x, 1) / (np.linalg.cond(x, 1) * np.sqrt(size)), EPS / 8) if size > 1 else 1.0
    low = min(low, 1.0) if np.isfinite(low) else EPS / 8
    for _ in range(20):
        # The weights that bring all singular values of [low, 1] nearest to 1.
        d = np.cbrt(max(4 * (1 - low**2) / low**4, 0.0))
        root = np.sqrt(1 + d)
        a = root + np.sqrt(max(8 - 4 * d + 8 * (2 - low**2) / (low**2 * root), 0.0)) / 2
        b = (a - 1) ** 2 / 4
        c = a + b - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, identity]))
        step = b / c * x + (a - b / c) / np.sqrt(c) * (q[:size] @ q[size:].T)
        done = np.linalg.norm(step - x) <= np.cbrt(4 * EPS) and abs(1 - low) < 1e-8
        x, low = step, min(low * (a + b * low**2) / (1 + c * low**2), 1.0)
        if done:
            break
    return x


def _halves(matrix: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, float] | None:
    """Bases of the spaces of eigenvalues above and below ``shift``, and what couples them."""
    size = len(matrix)
    signs = polar_factor(matrix - shift * np.eye(size))
    projector = (np.eye(size) + (signs + signs.T) / 2) / 2
    rank = int(round(np.trace(projector)))
    if not 0 < rank < size:
        return None
    # The columns of the projector with the largest norms span its space; twice is enough.
    start = projector[:, np.argsort(-np.einsum("ij,ij->j", projector, projector), kind="stable")[:rank]]
    q, _ = np.linalg.qr(start, mode="complete")
    q, _ = np.linalg.qr(np.column_stack([projector @ q[:, :rank], q[:, rank:] - projector @ q[:, rank:]]))
    upper, lower = q[:, :rank], q[:, rank:]
    return upper, lower, float(np.abs(lower.T @ matrix @ upper).max())


def _split(matrix: np.ndarray, basis: np.ndarray, scale: float, out: list[tuple[float, np.ndarray]]) -> None:
    size = len(matrix)
    middle = np.trace(matrix) / size
    apart = np.abs(matrix - middle * np.eye(size)).max()
    if size == 1 or apart <= EPS * scale:  # one component, or equal eigenvalues: any basis will do
        out += [(float(matrix[k, k]), basis[:, k]) for k in range(size)]
        return
    diagonal = np.sort(np.diag(matrix))
    shifts = [np.median(diagonal), middle, *np.linspace(middle - apart, middle + apart, 9)]
    best = None
    for shift in shifts:
        halves = _halves(matrix, float(shift))
        if halves and (best is None or halves[2] < best[2]):
            best = halves
        if best and best[2] <= 4 * EPS * scale:
            break
    if best is None:  # eigenvalues that no shift tells apart
        out += [(float(matrix[k, k]), basis[:, k]) for k in range(size)]
        return
    for half in best[:2]:
        part = half.T @ matrix @ half
        _split((part + part.T) / 2, basis @ half, scale, out)


def spectral_components(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns.

    Splits by polar decompositions; a last step of first order removes what rounding has left between the
    components. Equal eigenvalues get any orthogonal vectors of their space.
    """
    matrix = (matrix + matrix.T) / 2
    size = len(matrix)
    if not size:
        return np.empty(0), np.empty((0, 0))
    scale = float(np.abs(matrix).max()) or 1.0
    found: list[tuple[float, np.ndarray]] = []
    _split(matrix, np.eye(size), scale, found)
    vectors = np.column_stack([v for _, v in found])
    for _ in range(2):
        inner = vectors.T @ matrix @ vectors
        values = np.diag(inner)
        gaps = values[None, :] - values[:, None]
        clear = np.abs(gaps) > np.sqrt(EPS) * scale * 1e-3
        turn = np.where(clear, inner / np.where(clear, gaps, 1), 0)
        np.fill_diagonal(turn, 0)
        if np.abs(turn).max(initial=0) < 1e-3:
            vectors = vectors + vectors @ turn
        vectors, _ = np.linalg.qr(vectors)
    values = np.einsum("ij,ij->j", vectors, matrix @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# --- distributed sums ---


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: all of it has the size of the width of the vectors, squared."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray  # a column each
    values: np.ndarray
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums]) if self.n else np.zeros(len(self.sums))


def usable(vector: Column | str) -> Column:
    """Whether a vector is there and all its entries are finite."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def scaled(vector: Column | str, width: int) -> Column:
    """Entries as whole numbers: floor(64 * c) + 1,000,000, in ``width`` dimensions."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    most = F.lit(float(LARGEST))

    def whole(c: Column) -> Column:
        return F.floor(F.least(F.greatest(c.cast("double") * SCALE, -most), most)) + OFFSET

    numbers = F.transform(vector, whole)
    missing = F.lit(width) - F.size(vector)
    return F.when(missing <= 0, numbers).otherwise(F.concat(numbers, F.array_repeat(F.lit(OFFSET).cast("long"), missing)))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _moments(rows: DataFrame, width: int, project) -> tuple[int, np.ndarray, np.ndarray]:
    """Number, mean and covariance (divisor n, centred) of what ``project`` makes of the vectors ``x``.

    Every task centres its rows about their own mean before it multiplies; sums of the tasks' moments,
    one row for each pair of dimensions, give those of all.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, products = 0, 0.0, 0.0
        for batch in batches:
            if not batch.num_rows:
                continue
            values = project(_matrix(batch.column(0), width))
            m, centre = len(values), values.mean(axis=0)
            centred = values - centre
            apart = centre - mean
            products = products + centred.T @ centred + np.outer(apart, apart) * (n * m / (n + m))
            mean, n = mean + apart * (m / (n + m)), n + m
        if n:
            size = len(mean)
            i, j = np.triu_indices(size)
            columns = {"i": i, "j": j, "n": np.full(len(i), n), "a": mean[i], "b": mean[j], "p": products[i, j]}
            yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})

    parts = rows.select("x").mapInArrow(partial, "i long, j long, n long, a double, b double, p double")
    sums = parts.groupBy("i", "j").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("a")).alias("a"),
        F.sum(F.col("n") * F.col("b")).alias("b"),
        F.sum(F.col("p") + F.col("n") * F.col("a") * F.col("b")).alias("p"),
    )
    found = sums.toPandas()  # a row for each pair of dimensions
    if found.empty:
        return 0, np.zeros(0), np.zeros((0, 0))
    size = int(found["j"].max()) + 1
    covariance, n = np.zeros((size, size)), int(found["n"].iloc[0])
    means = found["a"] / n, found["b"] / n
    covariance[found["i"], found["j"]] = found["p"] / n - means[0] * means[1]
    mean = np.zeros(size)
    mean[found["i"]] = means[0]
    return n, mean, np.triu(covariance) + np.triu(covariance, 1).T


def fit(vectors: DataFrame, width: int, most: int = COMPONENTS) -> Whitening:
    """Fits on each distinct vector of the column ``x`` (``width`` whole numbers) once.

    Components whose eigenvalue is not above what rounding leaves of zero are left out, for nothing can be
    divided by it; without rows, or with a single distinct one, there are none.
    """
    distinct = stored(vectors.select("x").distinct(), "distinct")
    totals = distinct.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.col("x")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(width)],
    ).first()
    n, sums = totals["n"], tuple(int(totals[f"s{k}"] or 0) for k in range(width))
    mean = np.array([s / n for s in sums]) if n else np.zeros(width)
    nothing = Whitening(n, sums, np.zeros((width, 0)), np.zeros(0), 0.0, 0.0)
    if not n or not width:
        return nothing
    _, _, covariance = _moments(distinct, width, lambda x: x - mean)
    values, components = spectral_components(covariance)
    trace = float(np.trace(covariance))
    real = (values > width * EPS * max(values.max(initial=0), 0)) & (values > 0)
    values, components = values[real][:most], components[:, real][:, :most]
    if not len(values):
        return nothing
    weights = components / np.sqrt(values)
    _, _, white = _moments(distinct, width, lambda x: (x - mean) @ weights)
    error = float(np.abs(white - np.eye(len(values))).max())
    return Whitening(n, sums, components, values, trace, error)


def _deviations(x: np.ndarray, model: Whitening) -> list[int | None]:
    """Sums over dimensions of (n * x - S)^2, exactly; None where a long can't hold one."""
    centre = np.array([round(s / model.n) for s in model.sums], np.int64)
    rest = np.array([s - model.n * int(c) for s, c in zip(model.sums, centre)], np.int64)
    near = x - centre
    bound = model.n * int(np.abs(near).max(initial=0)) + int(np.abs(rest).max(initial=0))
    if bound**2 * max(x.shape[1], 1) < 1 << 63:
        apart = near * model.n - rest
        return np.einsum("ij,ij->i", apart, apart).tolist()
    apart = near.astype(object) * model.n - rest.astype(object)
    exact = (apart * apart).sum(axis=1).tolist()
    return [v if v < 1 << 63 else None for v in exact]


def transform(vectors: DataFrame, model: Whitening, x: str = "x", keep_x: bool = False) -> DataFrame:
    """Adds ``whitened`` (a list of one number for each component) and ``deviation`` to the rows.

    ``x`` holds whole numbers as ``scaled`` gives them. Columns of these names are replaced. The model is
    sent to all tasks; nothing is shuffled.
    """
    names = ("whitened", "deviation")
    kept = [c for c in vectors.columns if c.lower() not in names and (keep_x or c != x)]
    inner = spare([*kept, *names], "_in")
    kinds = [T.ArrayType(T.DoubleType()), T.LongType()]
    schema = T.StructType([*(vectors.schema[c] for c in kept), *map(T.StructField, names, kinds)])
    mean, weights = model.mean, model.components / np.sqrt(model.values)
    width, size = weights.shape

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in some_rows(whole):
                rows = batch.num_rows
                matrix = _matrix(batch.column(inner), width) if width else np.zeros((rows, 0), np.int64)
                white = pa.array(((matrix - mean) @ weights).ravel())
                offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * size)
                added = [pa.ListArray.from_arrays(offsets, white), pa.array(_deviations(matrix, model), pa.int64())]
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + added, [*kept, *names])

    return vectors.select(*kept, F.col(x).alias(inner)).mapInArrow(projected, schema)


def whitened(vectors: DataFrame, vector: str = "embedding", most: int = COMPONENTS) -> tuple[DataFrame, Whitening]:
    """The rows with usable vectors, each with ``whitened`` and ``deviation``, and the fitted model.

    Rows whose vector is NULL or holds NULL or a number that is not finite are left out. Entries become
    whole numbers (see ``scaled``); beyond 2^52 they count as 2^52. Vectors that are shorter than the
    longest one are continued with zeros. Each distinct vector counts once in the fit, repeated rows are
    all returned, with their other columns. Equal eigenvalues share a space in which the components are
    any; each keeps one sign for all rows.
    """
    x = spare(vectors.columns, "x")
    good = vectors.where(usable(vector))
    width = good.agg(F.max(F.size(vector)).alias("width")).first()["width"] or 0
    numbers = good.withColumn(x, scaled(vector, width))
    model = fit(numbers.select(F.col(x).alias("x")), width, most)
    return transform(numbers.drop(vector), model, x), model
