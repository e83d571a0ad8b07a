"""Whitening of embeddings on their leading principal components.

Entries become whole numbers x = floor(1024 * c) + 100000, in vectors as long as the longest one. Spark jobs sum,
over all vectors, first the entries, then the products of entries centred on the whole number next to the
mean. Both are exact whole numbers (the parts of a task are added in Spark as decimals), so the covariance is
rounded once and is the same at every run; nothing is cancelled, as entries are centred before they are multiplied.
The covariance is one small matrix, d by d; it is brought to tridiagonal form by Householder reflections,
its leading eigenvalues are found by bisection on Sturm counts, their vectors by inverse iteration, with
those of close eigenvalues made orthogonal to each other, and turned back. The projection is
broadcast. Another pass measures the covariance of the whitened values before rows are given out.

Defined cases: vectors that are null or hold a null, NaN or infinite entry are left out; vectors
shorter than the longest count as having zeros there; a component whose variance is at most ``FLAT`` of
the leading one's has no direction and is left out, so vectors that are all equal, or no vectors, give no
rows; rows are whitened one by one, so repeated rows and ids are kept. Deviations are exact and null
where they don't fit in a long. Entries beyond ``HUGE`` (as x, a million million) count as that. Memory: a task holds blocks of
``ROWS`` vectors, and d by d sums; so d is for the thousands at most, as embeddings have.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waveband.llm.shared import fresh_name

SCALE, SHIFT = 1024, 100_000
ROWS = 4096
HUGE = 10**12
FLAT = 1e-10
_EPS = float(np.finfo(np.float64).eps)
#: sums of ROWS products below this are exact in doubles
_EXACT = 1 << 20


def whole(vector: str) -> Column:
    """The vector as whole numbers; null if it is null or holds an entry that isn't finite."""
    c = lambda x: x.cast("double")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(c(x)) & (F.abs(c(x)) < float("inf")))
    x = lambda v: F.least(F.greatest(F.floor(F.least(F.greatest(c(v) * SCALE, F.lit(-1.0 * HUGE)), F.lit(1.0 * HUGE))) + SHIFT, F.lit(-HUGE)), F.lit(HUGE))
    return F.when(finite, F.transform(vector, x))


def _blocks(column: pa.Array, d: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Blocks of vectors as rows of a matrix, zeros (as x) behind the shorter ones."""
    for begin in range(0, len(column), ROWS):
        part = column.slice(begin, ROWS)
        sizes = part.value_lengths().to_numpy(zero_copy_only=False)
        values = part.flatten().to_numpy(zero_copy_only=False)
        matrix = np.full((len(part), d), SHIFT, np.int64)
        matrix[np.arange(d)[None, :] < sizes[:, None]] = values
        yield begin, begin + len(part), matrix


def _products(x: np.ndarray) -> np.ndarray:
    """``x.T @ x``, exactly, as Python numbers where needed."""
    if not x.size or np.abs(x).max() < _EXACT:
        return (x.T.astype(np.float64) @ x.astype(np.float64)).astype(np.int64)
    return x.T.astype(object) @ x.astype(object)


def _sums(vectors: DataFrame, name: str, cells: int, block, d: int) -> list[int]:
    """Sums over all vectors of what ``block`` makes of a matrix: ``cells`` whole numbers, added up in each task first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, object)
        for batch in batches:
            for _, _, matrix in _blocks(batch.column(0), d):
                total = total + block(matrix).astype(object)
        used = np.flatnonzero(total != 0)
        values = pa.array([int(v) for v in total[used]], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), values], names=["cell", "value"])

    found = vectors.select(name).mapInArrow(run, "cell int, value decimal(38,0)").groupBy("cell").agg(F.sum("value").alias("value"))
    sums = [0] * cells
    for r in found.collect():
        sums[r["cell"]] = int(r["value"])
    return sums


# ---- eigenvectors of a small symmetric matrix ------------------------------------------------

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the unit vectors of the Householder reflections that lead there."""
    a, reflections = a.astype(np.float64).copy(), []
    for k in range(len(a) - 2):
        v = a[k + 1 :, k].copy()
        length = np.linalg.norm(v)
        if length:
            v /= length
            v[0] += np.copysign(1.0, v[0])
            v /= np.linalg.norm(v)
            inner = a[k + 1 :, k + 1 :]
            p = inner @ v
            w = p - (v @ p) * v
            inner -= 2 * (np.outer(v, w) + np.outer(w, v))
            a[k + 1 :, k] -= 2 * v * (v @ a[k + 1 :, k])
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def _below(diagonal: np.ndarray, off: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues lie below each point."""
    least = max(float(np.abs(off).max(initial=0.0)), float(np.abs(diagonal).max())) * _EPS * _EPS
    q = diagonal[0] - points
    count = (q < 0).astype(np.int64)
    for k in range(1, len(diagonal)):
        q = np.where(np.abs(q) < least, -least, q)
        q = diagonal[k] - points - off[k - 1] ** 2 / q
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, many: int) -> np.ndarray:
    """The ``many`` largest eigenvalues, falling, by bisection on the Sturm counts."""
    reach = np.abs(np.concatenate([[0], off])) + np.abs(np.concatenate([off, [0]]))
    low = np.full(many, float((diagonal - reach).min()))
    high = np.full(many, float((diagonal + reach).max()))
    wanted = len(diagonal) - np.arange(many)  # of the k-th largest so many lie below any point above it
    for _ in range(120):
        middle = (low + high) / 2
        above = _below(diagonal, off, middle) >= wanted
        low, high = np.where(above, low, middle), np.where(above, middle, high)
    return (low + high) / 2


def _solved(diagonal: np.ndarray, off: np.ndarray, value: float, right: np.ndarray, least: float) -> np.ndarray:
    """Solution of (T - value) x = right, by elimination with row exchanges."""
    n = len(diagonal)
    main, upper, second, x = diagonal - value, np.append(off, 0.0), np.zeros(n), right.copy()
    for k in range(n - 1):
        if abs(off[k]) > abs(main[k]):
            ratio = main[k] / off[k]
            main[k], main[k + 1], upper[k], second[k], upper[k + 1] = off[k], upper[k] - ratio * main[k + 1], main[k + 1], upper[k + 1], -ratio * upper[k + 1]
            x[k], x[k + 1] = x[k + 1], x[k] - ratio * x[k + 1]
        else:
            main[k] = main[k] or least
            ratio = off[k] / main[k]
            main[k + 1] -= ratio * upper[k]
            x[k + 1] -= ratio * x[k]
    for k in range(n - 1, -1, -1):
        later = (upper[k] * x[k + 1] if k + 1 < n else 0.0) + (second[k] * x[k + 2] if k + 2 < n else 0.0)
        x[k] = (x[k] - later) / (main[k] if abs(main[k]) > least else least)
    return x


def leading_vectors(a: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``many`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns."""
    many = min(many, len(a))
    scale = float(np.abs(a).max())
    if not scale:
        return np.zeros(many), np.eye(len(a))[:, :many]
    diagonal, off, reflections = tridiagonal(a / scale)
    values = leading_values(diagonal, off, many)
    norm = max(float(np.abs(diagonal).max()), float(np.abs(off).max(initial=0.0)))
    vectors, shifted, seeds = [], np.inf, np.random.default_rng(1)
    start = 0  # of the cluster of close eigenvalues that the value belongs to
    for k in range(many):
        if k and values[k - 1] - values[k] > 1e-3 * norm:
            start = k
        # equal values are taken a little apart, so that they give different vectors
        shifted = min(values[k], shifted - 4 * _EPS * norm)
        x = seeds.standard_normal(len(a))
        for _ in range(5):
            x = _solved(diagonal, off, shifted, x / np.linalg.norm(x), _EPS * norm)
            for _ in range(2):
                for v in vectors[start:]:
                    x -= (v @ x) * v
        vectors.append(x / np.linalg.norm(x))
    back = np.array(vectors).T
    for k in range(len(reflections) - 1, -1, -1):
        v = reflections[k]
        back[k + 1 :] -= 2 * np.outer(v, v @ back[k + 1 :])
    return values * scale, back / np.linalg.norm(back, axis=0)


# ---- the operator ----------------------------------------------------------------------------

class Whitening(NamedTuple):
    """What the fit list gives: n, the entries' sums, eigenvalues, unit eigenvectors as columns, and the trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s // self.n + (s % self.n) / self.n for s in self.sums])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        centre = np.array([s // self.n for s in self.sums])  # whole numbers are taken off exactly
        return ((x - centre) - (self.mean - centre)) @ (self.vectors / np.sqrt(self.values))


def covariance(n: int, sums: list[int], centre: list[int], products: np.ndarray) -> np.ndarray:
    """From exact sums of the products of entries less ``centre``: rounded once at the end."""
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]
    square = n * n
    return np.array([[(n * int(products[i, j]) - rest[i] * rest[j]) / square for j in range(len(sums))] for i in range(len(sums))])


def fit(vectors: DataFrame, name: str, components: int = 8) -> Whitening | None:
    """The whitening of the vectors of whole numbers in column ``name``; None if no component is left."""
    d = vectors.agg(F.max(F.size(name))).collect()[0][0]
    if not d:
        return None
    *sums, n = _sums(vectors, name, d + 1, lambda m: np.append(m.sum(0), len(m)), d)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    upper = np.triu_indices(d)
    found = _sums(vectors, name, len(upper[0]), lambda m: _products(m - np.array(centre))[upper], d)
    products = np.zeros((d, d), object)
    products[upper] = products.T[upper] = found
    v = covariance(n, sums, centre, products)
    values, axes = leading_vectors(v, components)
    kept = values > max(FLAT * values[0], 0.0)
    return Whitening(n, sums, values[kept], axes[:, kept], float(np.trace(v))) if kept.any() else None


def _identity_error(vectors: DataFrame, name: str, model, d: int, k: int) -> float:
    """The largest absolute entry of the whitened values' covariance less the identity, from another pass."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for _, _, matrix in _blocks(batch.column(0), d):
                w = model.value.whitened(matrix)
                sums, products = sums + w.sum(0), products + w.T @ w
        cells = np.concatenate([sums, products.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells), dtype=np.int32)), pa.array(cells)], names=["cell", "value"])

    found = vectors.select(name).mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    cells = np.array([r["value"] for r in sorted(found)]) / model.value.n
    mean, products = cells[:k], cells[k:].reshape(k, k)
    return float(np.abs(products - np.outer(mean, mean) - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """For each row the sum of (n * x - S) ** 2, exactly; None beyond a long."""
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]
    y = x - np.array(centre)
    small = np.abs(y).max(initial=0) < _EXACT and n < 1 << 31
    y = y if small else y.astype(object)
    squares = (y * y).sum(1)
    # n * n * squares - 2 * n * cross + rests, from numbers that fit, put together as Python numbers
    cross = y @ np.array(rest, np.int64 if small else object) if len(rest) * n < 1 << 42 else y.astype(object) @ np.array(rest, object)
    rests = sum(r * r for r in rest)
    whole_ = [n * n * int(q) - 2 * n * int(c) + rests for q, c in zip(squares, cross, strict=True)]
    return [v if v < 1 << 63 else None for v in whole_]


def whiten(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = 8) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` of every vector and component."""
    name = fresh_name(embeddings, "x")
    vectors = embeddings.select(F.col(vec_id), whole(vector).alias(name)).where(F.col(name).isNotNull())
    fields = [("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()), ("whitened", T.DoubleType()), ("explained", T.DoubleType()), ("identity_error", T.DoubleType())]
    schema = T.StructType([vectors.schema[vec_id], *(T.StructField(f, kind) for f, kind in fields)])
    fitted = fit(vectors, name, components)
    spark = embeddings.sparkSession
    if fitted is None:
        return spark.createDataFrame([], schema)
    model = spark.sparkContext.broadcast(fitted)  # d by `components` numbers
    d, k = fitted.vectors.shape
    error = _identity_error(vectors, name, model, d, k)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in batches:
            for begin, end, matrix in _blocks(batch.column(1), d):
                rows = end - begin
                each = pa.array(np.repeat(np.arange(rows), k))
                deviation = pa.array(deviations(matrix, own.n, own.sums), pa.int64())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(begin, rows).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, own.n)), deviation.take(each), pa.array(own.whitened(matrix).ravel()),
                    pa.array(np.tile(own.values / own.trace, rows)), pa.array(np.full(rows * k, error))], names=schema.names)

    return vectors.mapInArrow(run, schema)
