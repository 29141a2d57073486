"""Quality: gradients by differences, attention, held-out accuracy, edge cases."""

import numpy as np
import pyarrow as pa
import pytest

from pulsemart.llm import quality, queries


def test_held_out(spark, sf_dir):
    found = queries.op4_quality(spark, sf_dir).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    known = [(labels[r.doc_id], r.predicted) for r in found if r.held_out and r.doc_id in labels]
    assert sum(t == p for t, p in known) / len(known) > 0.95
    assert len(found) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)


def test_gradients_by_differences():
    random = np.random.default_rng(3)
    passages, y = np.array([2, 1, 4]), np.array([1.0, 0.0, 1.0])
    x = random.normal(size=(7, 5))
    shapes = {"w": (5, 4), "wb": 4, "v": (4, 3), "u": (4, 3), "a": 3, "c": 4, "cb": 1}
    w = {k: random.normal(size=s) for k, s in shapes.items()}

    def loss(w):
        p = quality.forward(w, x, passages)["p"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean() + quality.DECAY / 2 * ((w["w"] ** 2).sum() + (w["c"] ** 2).sum())

    for k, g in quality.gradients(w, x, passages, y).items():
        for at in np.ndindex(g.shape):
            up, down = {**w, k: w[k].copy()}, {**w, k: w[k].copy()}
            up[k][at] += 1e-6
            down[k][at] -= 1e-6
            assert g[at] == pytest.approx((loss(up) - loss(down)) / 2e-6, abs=1e-6)


def test_attention_sums_to_one():
    x, passages = quality.encode(pa.array(["a " * 200, None, "b c"]))
    assert passages.tolist() == [4, 1, 1] and x.shape == (6, quality.FEATURES + 2)
    assert not x[4].any()
    random = np.random.default_rng(0)
    shapes = {"w": (x.shape[1], 4), "wb": 4, "v": (4, 3), "u": (4, 3), "a": 3, "c": 4, "cb": 1}
    f = quality.forward({k: random.normal(size=s) for k, s in shapes.items()}, x, passages)
    assert np.add.reduceat(f["attention"], [0, 4, 5]) == pytest.approx([1, 1, 1])


def test_new_pairs_by_hand():
    assert quality.new_pairs(np.array([0, 1, 0, 1, 0, 1]), np.array([0, 0, 0, 0, 1, 1])).tolist() == [1, 1, 1, 0, 1, 1]


def test_odd_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = [(1, None, 0), (2, "", 0), (3, "Shti " * 200_000, 0), (4, "x", 0), (4, "x", 0), (None, "y z", 0)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, predicted int")
    got = quality.score_quality(odd, model).collect()
    scores = {r.doc_id: r.score for r in got}
    assert len(got) == 6 and scores[1] == scores[2] and all(0 <= s <= 1 for s in scores.values())
    assert scores[3] < 0.7
    assert quality.score_quality(odd.limit(0), model).count() == 0
    nothing = quality.fit_quality(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert nothing is None
    assert {r.score for r in quality.score_quality(odd, nothing).collect()} == {0.5}
