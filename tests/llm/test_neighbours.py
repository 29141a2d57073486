"""Nearest neighbours: recall against brute force, ties, unusable vectors, the stopping test."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsemart.llm import neighbours, queries


def brute_force(rows, is_query, k):
    rows = sorted({(i, tuple(v)) for i, v in rows})
    ids = np.array([r[0] for r in rows])
    v = np.array([r[1] for r in rows], dtype=float)
    out = {}
    for i, q in zip(ids, v):
        if is_query(i):
            d = np.sqrt(((v - q) ** 2).sum(axis=1))
            order = np.lexsort((ids, d))
            out[i] = [(int(ids[j]), d[j]) for j in order if ids[j] != i][:k]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r["rank"]
    return out


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want = brute_force(rows, lambda i: i % 100 == 0, 10)
    got = answers(queries.op1_neighbours(spark, folder))
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    exact = {q: dict(w) for q, w in want.items()}
    for q, found in got.items():
        assert all(s == pytest.approx(exact[q][i], abs=1e-12) for i, s in found if i in exact[q])


def test_many_cells_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL", 64)
    monkeypatch.setattr(neighbours, "QUERIES", 20)
    random = np.random.default_rng(5)
    centres = random.normal(size=(8, 24))
    v = centres[random.integers(0, 8, 1500)] + 0.2 * random.normal(size=(1500, 24))
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    rows += [(5000 + i, v[0].tolist()) for i in range(400)]  # one hot vector
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = answers(neighbours.nearest_neighbours(df, F.col("vec_id") % 25 == 0))
    want = brute_force(rows, lambda i: i % 25 == 0, 10)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    assert got[5000] == want[5000] and got[0] == want[0]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]),
        (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0]), (None, [1.0, 1.0]), (9, [2.0, 0.0]),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int")
    got = answers(neighbours.nearest_neighbours(df, F.col("vec_id") >= 0))
    assert got.keys() == {0, 1, 2, 9}
    assert got[0] == [(1, 0.0), (9, 1.0), (2, pytest.approx(2**0.5))]
    assert [i for i, _ in got[2]] == [0, 1, 9]
    assert neighbours.nearest_neighbours(df.limit(0), F.col("vec_id") >= 0).count() == 0
    assert neighbours.nearest_neighbours(df.where("vec_id = 0"), F.col("vec_id") >= 0).count() == 0


def test_chi_square_limit():
    assert neighbours.chi_square_limit(0.95, 10) == pytest.approx(18.307, abs=1e-3)
    assert neighbours.chi_square_limit(0.5, 2) == pytest.approx(1.3863, abs=1e-4)


@pytest.mark.parametrize("spread,most", [(0.05, 0.05), (0.5, 0.2), (1.0, 0.6)])
def test_search_stops(spread, most):
    random = np.random.default_rng(7)
    centres = random.normal(size=(200, 64))
    v = centres[random.integers(0, 200, 10_000)] + spread * random.normal(size=(10_000, 64))
    queries_of = v[::200]
    bounds, ones = np.full(len(queries_of), np.inf), np.ones(len(v), dtype=int)
    hits = verified = 0
    for q, rows, distance, n in neighbours.search_block(v, ones, queries_of, bounds, 11):
        want = set(np.argsort(((v - queries_of[q]) ** 2).sum(axis=1), kind="stable")[:11])
        hits += len(want & set(rows[np.argsort(distance, kind="stable")[:11]]))
        verified += n
    assert hits >= 0.9 * 11 * len(queries_of)
    assert verified <= most * len(v) * len(queries_of)


def test_hot_cells_only_are_copied(spark, monkeypatch):
    """More queries than a task holds in one cell: its vectors go to several tasks, answers stay whole."""
    monkeypatch.setattr(neighbours, "CELL", 128)
    monkeypatch.setattr(neighbours, "QUERIES", 16)
    random = np.random.default_rng(9)
    v = np.concatenate([0.01 * random.normal(size=(300, 8)), 5 + random.normal(size=(300, 8))])
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = answers(neighbours.nearest_neighbours(df, F.col("vec_id") < 200))
    want = brute_force(rows, lambda i: i < 200, 10)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert got.keys() == want.keys() and hits >= 0.9 * 2000
    assert all(len(got[q]) == 10 for q in want)
