"""Stupid backoff: oracle, a plain computation, many partitions, edge cases."""

import math
from collections import Counter

import pyarrow as pa
import pytest

from pulsemart.llm import ngrams, oracle, queries
from tests.compare import connect, duck_rows, spark_rows


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_equals_sql(spark, folder):
    got = spark_rows(queries.op2_stupid_backoff(spark, folder))
    assert got == duck_rows(connect(folder), oracle.ORACLES["op2_stupid_backoff"])


def plain(texts, order, least):
    words = [(t or "").lower().split() for t in texts]
    counts = Counter(tuple(w[i : i + k]) for w in words for k in range(1, order + 1) for i in range(len(w) - k + 1))
    total = sum(map(len, words))

    def score(gram):
        if len(gram) == 1:
            return math.log(counts[gram] / total)
        if counts[gram] >= least:
            return math.log(counts[gram] / counts[gram[:-1]])
        return math.log(0.4) + score(gram[1:])

    return [sum(score(tuple(w[max(0, i - order + 1) : i + 1])) for i in range(len(w))) for w in words]


@pytest.mark.parametrize("order,least", [(1, 1), (2, 1), (3, 2), (4, 3)])
def test_many_blocks_and_partitions(spark, sf_dir, monkeypatch, order, least):
    monkeypatch.setattr(ngrams, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(ngrams, "PARTITION_WORDS", 500)
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 120").collect()]
    texts += [None, "", " \t", "the " * 5000, texts[0], texts[0]]
    rows = [(i if i != 3 else None, t, 1.0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double").repartition(3)
    got = {r.doc_id: r for r in ngrams.score_documents(docs, order, least).collect()}
    want = plain(texts, order, least)
    assert len(got) == len(texts)
    for i, w in enumerate(want):
        assert got[i if i != 3 else None].score == pytest.approx(w, abs=1e-6)
    empty = got[len(texts) - 5]
    assert (empty.words, empty.score, empty.per_word) == (0, 0.0, None)


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ngrams.score_documents(docs).count() == 0
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [r.score for r in ngrams.score_documents(docs).collect()] == [0.0, 0.0]


def test_text_is_shuffled_once(spark, sf_dir):
    df = ngrams.score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_packing():
    block = ngrams.Block(pa.array(["b a b", None, "a b"]), 2)
    assert block.starts.tolist() == [0, 3, 3, 5]
    assert sorted(block.counts[0].tolist()) == [2, 3]
    assert block.index[1][0] == block.index[1][3] == -1
    values = block.hashes[1]
    assert ngrams.unpacked(ngrams.packed(values), len(values)).tolist() == values.tolist()
