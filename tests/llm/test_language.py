"""Language identification: held-out accuracy, rejection, the model's arithmetic, edge cases."""

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pulsemart.llm import langid, queries


def test_held_out_accuracy(spark, sf_dir):
    found = queries.op5_language(spark, sf_dir)
    lang = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = found.join(lang, "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)
    assert found.count() == lang.count()
    assert not any(r.rejected for r in rows)


def plain_kneser_ney(texts, order):
    """Probabilities by definition, n-grams as strings."""
    counts = [defaultdict(Counter) for _ in range(order + 1)]
    left = [defaultdict(set) for _ in range(order + 1)]
    for text in texts:
        for word in text.split():
            padded = f" {word} "
            for i in range(1, len(padded)):
                for k in range(1, order + 1):
                    if i - k + 1 < 0:
                        break
                    gram = padded[i - k + 1 : i + 1]
                    counts[k][gram[:-1]][gram[-1]] += 1
                    if i - k >= 0:
                        left[k][gram].add(padded[i - k])
    seen = [None] * (order + 1)
    for k in range(1, order + 1):
        seen[k] = {}
        for context, tails in counts[k].items():
            for char, n in tails.items():
                gram = context + char
                initial = k > 1 and gram[0] == " "
                seen[k][gram] = n if k == order or initial or not left[k][gram] else len(left[k][gram])
    size = len(seen[1]) + 1

    def probability(gram):
        k = len(gram)
        if k == 0:
            return 1 / size
        values = list(seen[k].values())
        once, twice = values.count(1), values.count(2)
        discount = min(max(once / max(once + 2 * twice, 1), 0.1), 0.9)
        inside = [v for g, v in seen[k].items() if g[:-1] == gram[:-1]]
        if not inside:
            return probability(gram[1:])
        total = sum(inside)
        return max(seen[k].get(gram, 0) - discount, 0) / total + discount * len(inside) / total * probability(gram[1:])

    return probability


def test_probabilities_by_definition(spark):
    texts = ["anna banana ananas", "nab an bann", "banana"]
    sample = spark.createDataFrame([("x", t, True) for t in texts], "lang string, text string, fits boolean")
    model = langid.kneser_ney(langid.ngram_counts(sample).toArrow())
    probability = plain_kneser_ney(texts, langid.ORDER)
    for word in ["banana", "nan", "zebra", "ab", "n"]:
        logs, count = model.word_scores(pa.array([word], pa.large_string()))
        padded = f" {word} "
        want = sum(math.log(probability(padded[max(0, i - langid.ORDER + 1) : i + 1])) for i in range(1, len(padded)))
        assert count[0] == len(word) + 1
        assert logs[0, 0] == pytest.approx(want, rel=1e-4)


def test_odd_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.fit_language_model(docs)
    texts = [None, "", " \n\t", "12345 !!! 67", "привет как дела сегодня " * 40, "the " * 300_000, "the of and", "the of and"]
    rows = [(i, t, "clash", "x") for i, t in enumerate(texts)] + [(None, "the of and", None, "x")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, rejected string")
    got = {r.doc_id: r for r in langid.identify_language(odd, model).collect()}
    assert len(got) == len(rows)
    assert [got[i].lang_pred for i in range(4)] == ["und"] * 4 and got[0].score == 0
    assert got[4].rejected and got[4].lang_pred in model.languages
    assert got[5].lang_pred == got[6].lang_pred == "en" and not got[6].rejected
    kept = langid.keep_known_languages(odd, model)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [5, 6, 7]
    assert langid.identify_language(odd.limit(0), model).count() == 0


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    model = langid.fit_language_model(docs)
    assert langid.identify_language(docs, model).collect()[0].lang_pred == "und"
    model = langid.fit_language_model(docs.withColumn("lang", F.lit("aa")), F.lit(True))
    assert langid.identify_language(docs, model).collect()[0].lang_pred == "aa"


def test_position():
    table = np.array([3, 5, 9], dtype=np.uint64)
    assert langid.position(table, np.array([9, 4, 3, 10], dtype=np.uint64)).tolist() == [2, -1, 0, -1]
    assert langid.position(table[:0], np.array([1], dtype=np.uint64)).tolist() == [-1]
