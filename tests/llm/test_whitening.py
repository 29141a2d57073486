"""Whitening against numpy's eigenvectors and whole-number arithmetic."""

import math
from collections import defaultdict

import numpy as np
import pytest

from pulsemart.llm import queries, whitening
from pulsemart.llm.queries import table


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    return (q * np.array(values)) @ q.T


MATRICES = {
    "falling": symmetric(np.geomspace(1e6, 1e-2, 40)),
    "equal": np.eye(12) * 3,
    "pairs": symmetric([5, 5, 5, 2, 2, 1, 1, 1, 1, 0.5]),
    "blocks": np.kron(np.eye(4), symmetric([3, 2, 1], 1)),
    "near": symmetric([1, 1 - 1e-9, 1 - 2e-9, 1 - 1e-5, 0.9] + [0.1] * 35),
    "wilkinson": np.diag(np.abs(np.arange(-10.0, 11))) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1) + 2 * np.eye(21),
    "diagonal": np.diag([1.0, 9, 4, 4, 0.25]),
    "one": np.array([[2.5]]),
    "two": np.array([[2.0, 1], [1, 2]]),
    "tiny": symmetric([4, 3, 2, 1]) * 1e-200,
    "huge": symmetric([4, 3, 2, 1]) * 1e200,
    "rank 2": symmetric([7, 3, 0, 0, 0, 0]),
}


@pytest.mark.parametrize("name", MATRICES)
def test_components(name):
    matrix = (MATRICES[name] + MATRICES[name].T) / 2
    values, vectors = whitening.principal_components(matrix)
    want = np.linalg.eigvalsh(matrix)[::-1][:32]
    kept = 2 if name == "rank 2" else len(want)
    scale = want[0]
    assert len(values) == kept
    assert np.allclose(values / scale, want[:kept] / scale, rtol=0, atol=1e-13)
    assert np.allclose(vectors.T @ vectors, np.eye(kept), atol=1e-12)
    assert np.abs(matrix @ vectors - vectors * values).max() / scale < 1e-12
    assert (np.diff(values) <= 0).all()


def test_sturm_counts():
    diagonal, off, _ = whitening.tridiagonal(MATRICES["pairs"])
    at = np.array([-1, 0.7, 1.5, 3, 6.0])
    assert whitening.count_below(diagonal, off, at).tolist() == [0, 1, 5, 7, 10]


def test_exact_products_of_any_size():
    for size in (300, 10**6, 10**8, 10**12):
        left = np.random.default_rng(1).integers(-size, size, (50, 3))
        want = [[sum(int(a) * int(b) for a, b in zip(left[:, i], left[:, j])) for j in range(3)] for i in range(3)]
        assert whitening.exact_products(left, left).tolist() == want


def plain(rows):
    """Whole-number statistics of (id, vector) rows, and numpy's components."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    deviation = [sum((n * r[j] - sums[j]) ** 2 for j in range(d)) for r in x]
    centred = np.array([[(n * r[j] - sums[j]) / n for j in range(d)] for r in x])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    return n, deviation, centred, covariance, values[::-1], vectors[:, ::-1]


def check(rows, result, most=32):
    n, deviation, centred, covariance, values, vectors = plain(rows)
    k = min(most, len(values))
    found = defaultdict(list)
    for r in result:
        found[r.vec_id].append(r)
    assert len(result) == n * k
    whitened = np.zeros((n, k))
    for i, (key, _) in enumerate(rows):
        own = sorted(found[key], key=lambda r: r.component)
        assert [r.component for r in own] == list(range(1, k + 1))
        assert {(r.n, int(r.deviation)) for r in own} == {(n, deviation[i])}
        assert np.allclose([r.explained for r in own], values[:k] / np.trace(covariance), rtol=1e-9)
        whitened[i] = [r.whitened for r in own]
    errors = {r.identity_error for r in result}
    assert len(errors) == 1 and max(errors) < 1e-8
    assert np.abs(whitened.T @ whitened / n - np.eye(k)).max() < 1e-8
    # Equal up to the sign of each component.
    want = centred @ vectors[:, :k] / np.sqrt(values[:k])
    signs = np.sign((want * whitened).sum(axis=0))
    assert np.allclose(whitened * signs, want, atol=1e-6)


def test_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf_dir, "embeddings").collect()]
    rows = [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]
    check(rows, queries.op11_whitening(spark, sf_dir).collect())


def test_rows_left_out_and_extra_columns(spark):
    some = np.random.default_rng(2).normal(size=(200, 5)) * [9, 5, 3, 1, 0.5]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(some)]
    bad = [(500, None), (501, []), (502, [1.0, None, 1.0, 1.0, 1.0]), (503, [float("nan")] * 5), (504, [float("inf")] * 5), (505, [1.0, 2.0])]
    data = [(*r, "c", 1, 0.5) for r in rows + bad]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>, component string, n int, whitened double")
    result = whitening.whiten(frame.repartition(7)).collect()
    check(rows, result)
    check(rows, whitening.whiten(frame, most=2).collect(), most=2)
    # The same rows in other parts give the same statistics, bit for bit.
    again = whitening.whiten(frame.repartition(2, "vec_id")).collect()
    key = lambda r: (r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained)
    assert sorted(map(key, again)) == sorted(map(key, result))


def test_no_variance(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(9)], schema)).collect() == []
    line = spark.createDataFrame([(None, [float(i), 1.0]) for i in range(9)], schema)
    found = whitening.whiten(line).collect()
    assert [r.component for r in found] == [1] * 9 and abs(found[0].explained - 1) < 1e-15
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whiten(line.limit(0)).columns == whitening.whiten(line).columns == names
