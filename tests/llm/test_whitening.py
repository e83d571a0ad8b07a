"""Whitening against numpy's eigenvectors, exact numbers, and defined cases."""

from __future__ import annotations

import math

import numpy as np
import pytest

pytest.importorskip("waveband.llm")
from waveband.llm import whitening  # noqa: E402
from waveband.llm.queries import QUERIES, table  # noqa: E402

SF = "/root/testdata/sf0.01"


def whole(vectors) -> list[list[int]]:
    return [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]


def test_the_query_equals_numpy(spark):
    given = {r["vec_id"]: r["embedding"] for r in table(spark, SF, "embeddings").collect()}
    x = np.array(whole([given[i] for i in sorted(given)]))
    n, sums = len(x), x.sum(0)
    centred = x - sums / n
    v = centred.T @ centred / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:8], axes[:, ::-1][:, :8]
    want = centred @ axes / np.sqrt(values)
    got = QUERIES["op13_embedding_whitening"](spark, SF).orderBy("vec_id", "component").collect()
    assert [(r["vec_id"], r["component"]) for r in got] == [(i, k) for i in sorted(given) for k in range(1, 9)]
    whitened = np.array([r["whitened"] for r in got]).reshape(n, 8)
    side = np.sign((whitened * want).sum(0))
    assert np.abs(whitened * side - want).max() < 1e-9
    assert [r["deviation"] for r in got[::8]] == [int(((n * row - sums) ** 2).sum()) for row in x.astype(object)]
    assert [r["explained"] for r in got[:8]] == pytest.approx((values / np.trace(v)).tolist(), rel=1e-9)
    errors = {r["identity_error"] for r in got}
    assert len(errors) == 1 and errors.pop() < 1e-9 and {r["n"] for r in got} == {n}
    assert np.abs(whitened.T @ whitened / n - np.eye(8)).max() < 1e-9


@pytest.mark.parametrize("size", [1, 2, 3, 7, 40])
def test_leading_vectors_of_random_matrices(size):
    rng = np.random.default_rng(size)
    for scale in (1e-150, 1.0, 1e150):
        a = rng.standard_normal((size, size))
        a = (a + a.T) * scale
        values, vectors = whitening.leading_vectors(a, 8)
        want = np.linalg.eigvalsh(a)[::-1][:8]
        assert np.abs(values - want).max() <= 1e-13 * np.abs(want).max()
        assert np.abs(a @ vectors - vectors * values).max() <= 1e-12 * np.abs(a).max() * size
        assert np.abs(vectors.T @ vectors - np.eye(vectors.shape[1])).max() < 1e-13


def test_equal_and_close_eigenvalues_get_orthogonal_vectors():
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.standard_normal((20, 20)))
    for own in ([5.0] * 12 + [1.0] * 8, [9, 9, 9 - 1e-13, 9 - 1e-9, 3, 3, 3, 3, 2, 1, *[0.0] * 10], [0.0] * 20, [1.0] + [0.0] * 19):
        for basis in (np.eye(20), q):
            a = basis @ np.diag(own) @ basis.T
            a = (a + a.T) / 2
            values, vectors = whitening.leading_vectors(a, 8)
            assert np.abs(values - sorted(own, reverse=True)[:8]).max() < 1e-12
            assert np.abs(a @ vectors - vectors * values).max() < 1e-12
            assert np.abs(vectors.T @ vectors - np.eye(8)).max() < 1e-12


def test_tridiagonal_form_has_the_same_eigenvalues():
    a = np.random.default_rng(4).standard_normal((9, 9))
    a = a + a.T
    diagonal, off, _ = whitening.tridiagonal(a)
    t = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    assert np.linalg.eigvalsh(t).tolist() == pytest.approx(np.linalg.eigvalsh(a).tolist())
    points = np.array([-100.0, 0.1, 100.0])
    assert whitening._below(diagonal, off, points).tolist() == [(np.linalg.eigvalsh(a) < p).sum() for p in points]


def frame(spark, vectors):
    rows = [(k, v, 0.5, 1) for k, v in vectors]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, whitened double, x int").repartition(3)


def test_defined_cases(spark):
    vectors = [(1, [0.5, 1.0, -0.25]), (1, [0.5, 1.0, -0.25]), (2, [0.25, -1.0]), (None, [0.0, 0.5, 0.125]), (3, None), (4, [1.0, None, 2.0]), (5, [1.0, float("nan"), 2.0]), (6, [1.0, float("inf"), 0.0]), (7, [])]
    got = whitening.whiten(frame(spark, vectors)).collect()
    kept = [[0.5, 1.0, -0.25], [0.5, 1.0, -0.25], [0.25, -1.0, 0.0], [0.0, 0.5, 0.125], [0.0, 0.0, 0.0]]
    x = np.array(whole(kept), object)
    n, sums = 5, x.sum(0)
    assert sorted({(r["vec_id"] is None, r["vec_id"], r["deviation"]) for r in got}) == sorted({(i is None, i, int(((n * row - sums) ** 2).sum())) for i, row in zip([1, 1, 2, None, 7], x, strict=True)})
    assert len(got) == 5 * 3 and {r["n"] for r in got} == {5} and {r["component"] for r in got} == {1, 2, 3}
    assert got[0]["identity_error"] < 1e-9 and sum({r["component"]: r["explained"] for r in got}.values()) == pytest.approx(1)


@pytest.mark.parametrize("vectors", [[], [(1, None)], [(1, [0.5, 1.0])], [(i, [0.5, 1.0]) for i in range(5)], [(1, []), (2, [])]])
def test_nothing_to_whiten_gives_no_rows(spark, vectors):
    got = whitening.whiten(frame(spark, vectors))
    assert got.count() == 0 and got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_a_flat_direction_is_left_out(spark):
    got = whitening.whiten(frame(spark, [(i, [float(i % 7), float(i % 7), float(i % 3)]) for i in range(40)])).collect()
    assert {r["component"] for r in got} == {1, 2} and got[0]["identity_error"] < 1e-9


def test_large_numbers_stay_exact():
    rng = np.random.default_rng(3)
    x = rng.integers(-(10**12), 10**12, (50, 4))
    assert (whitening._products(x) == x.T.astype(object) @ x.astype(object)).all()
    sums = [int(s) for s in x.sum(0)]
    want = [int(((50 * row - np.array(sums, object)) ** 2).sum()) for row in x.astype(object)]
    assert whitening.deviations(x, 50, sums) == [v if v < 1 << 63 else None for v in want]
    small = rng.integers(99_000, 101_000, (50, 4))
    many = 10**6 + 7  # as if there were more vectors
    sums = [int(s) * 20_000 + 11 for s in small.sum(0)]
    want = [int(((many * row - np.array(sums, object)) ** 2).sum()) for row in small.astype(object)]
    assert whitening.deviations(small, many, sums) == [v if v < 1 << 63 else None for v in want]


def test_entries_that_are_huge(spark):
    got = whitening.whiten(frame(spark, [(i, [3e38 if i == 2 else float(i), float(i * i)]) for i in range(9)])).collect()
    assert len(got) == 18 or len(got) == 9
    assert all(math.isfinite(r["whitened"]) for r in got)
