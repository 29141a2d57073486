"""Toxicity: the automaton against plain edit distance, windows, held-out accuracy, edge cases."""

import random

import numpy as np
import pyarrow as pa
import pytest

from pulsemart.llm import queries, toxicity
from pulsemart.llm.text import coded_words


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def best_match(lexicon, word):
    found = []
    for n, entry in enumerate(lexicon.entries):
        shown = [word[:i] for i in range(len(word) + 1)] if lexicon.begins[n] else [word]
        errors = min(distance(entry, s) for s in shown)
        if errors == 0 or errors == 1 and lexicon.fuzzy[n] > 0:
            found.append((errors, n))
    return 2 * min(found)[1] + min(found)[0] if found else -1


def test_automaton_equals_edit_distance():
    entries = ["abba", "abbot", "cab", "bcabc", "acca"]
    lexicon = toxicity.Lexicon(entries, np.array([0, 0, 1, 1, 0], dtype=bool), np.full(5, 0.9), np.array([0.8, 0.8, 0, 0.8, 0]))
    automaton = toxicity.build_automaton(lexicon)
    pick = random.Random(1)
    words = ["".join(pick.choices("abcotx", k=pick.randint(0, 8))) for _ in range(4000)] + entries
    got = automaton.read(pa.array(words, pa.large_string()))
    assert got.tolist() == [best_match(lexicon, w) for w in words]
    assert (got >= 0).sum() > 40


@pytest.fixture(scope="module")
def model():
    lexicon = toxicity.Lexicon(["dreadful", "vile"], np.array([False, False]), np.array([0.95, 0.9]), np.array([0.8, 0.0]))
    return toxicity.ToxicityModel(lexicon, toxicity.build_automaton(lexicon), 0.01)


def test_windows_tell_quotation_from_abuse(model):
    texts = [
        "such a dreadful man", "such a Dreadfull, man", "he wrote \"such a dreadful man\" then", "you dreadful man",
        "a vyle man", "nothing here", "said “vile”, a word",
    ]
    scores = model.scores(pa.array(texts))
    assert scores[0] > 0.5 and scores[1] > 0.5 and scores[3] >= scores[0]
    assert scores[2] < 0.5 and scores[6] < 0.5 and scores[2] < scores[0]
    assert scores[4] == scores[5] == pytest.approx(0.01)


def test_windows_stay_in_their_text(model):
    texts = pa.array(["wrote \"", "a vile thing", "\" end"])
    assert model.scores(texts)[1] == model.scores(pa.array(["a vile thing"]))[0]


def test_held_out(spark, sf_dir):
    found = queries.op7_toxicity(spark, sf_dir).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    known = [(labels[r.doc_id], r.predicted) for r in found if r.held_out and r.doc_id in labels]
    assert sum(t == p for t, p in known) / len(known) > 0.9
    assert len(found) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.predicted == (r.score >= 0.5) for r in found)


def test_copies_are_no_evidence(spark):
    texts = [(i, f"w{i} plain words here", 0) for i in range(300)]
    texts += [(1000 + i, f"v{i} nasty words here", 1) for i in range(20)]
    texts += [(2000 + i, "nasty unrelated companion", 1) for i in range(50)]
    docs = spark.createDataFrame([t[:2] for t in texts], "doc_id long, text string")
    labels = spark.createDataFrame([(t[0], t[2]) for t in texts], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    assert model.lexicon.entries == ["nasty"]


def test_odd_rows(spark, model):
    rows = [(1, None, 1), (2, "", 1), (3, "vile " * 100_000, 1), (4, "\t\n", 1), (5, "vile", 1), (5, "vile", 1), (None, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    got = sorted(((r.doc_id or 0), r.predicted) for r in toxicity.score_toxicity(docs, model).collect())
    assert got == [(0, 0), (1, 0), (2, 0), (3, 1), (4, 0), (5, 1), (5, 1)]
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == 4
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    assert toxicity.score_toxicity(docs, model).collect()[0].predicted == 0


def test_distinct_pairs():
    words = coded_words(pa.array(["a b a", "", "b c"]))
    text, key = toxicity.distinct_pairs(words, np.array([0, 1, -1]), 3)
    assert list(zip(text, key)) == [(0, 0), (0, 1), (2, 1)]
