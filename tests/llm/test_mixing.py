"""Mixing: oracle, targets, repetition limits, edge cases."""

import pytest

from pulsemart.llm import mixing, oracle, queries
from tests.compare import connect, duck_rows, spark_rows


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_equals_sql(spark, folder):
    got = spark_rows(queries.op10_mix_sources(spark, folder))
    assert got == duck_rows(connect(folder), oracle.ORACLES["op10_mix_sources"])


def test_excess_is_shared_again(spark):
    docs = [(1, "a"), (2, "b " * 100), (3, "c " * 50), (4, "d"), (5, "e " * 1000)]
    rows = [(i, t, s) for (i, t), s in zip(docs, ["s1", "s2", "s3", "s4", "s5"])]
    out = mixing.mix_sizes(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    target = {r.source: r.target for r in out}
    assert target["s1"] == 3 and target["s4"] == 3
    assert sum(target.values()) == pytest.approx(1152)
    for r in out:
        assert r.target <= 3 * r.source_size and r.taken <= 3 * r.size
    assert target["s3"] == 150  # capped too, once s1 and s4 have given up their shares


def test_odd_rows(spark):
    rows = [
        (None, "a b", None, 1), (1, None, "x", 1), (2, "", "x", 1), (3, "c d e", "x", 1), (3, "c d e", "x", 1),
        (4, "w " * 200_000, "é", 1), (5, "\x0b\x1c  z", "Z", 1), (6, None, "empty", 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, rate int")
    out = mixing.mix_sizes(docs).collect()
    assert len(out) == len(rows)
    size = {(r.doc_id, r.source): r.size for r in out}
    assert size[(None, None)] == 2 and size[(1, "x")] == 0 and size[(5, "Z")] == 2
    repeated = [r for r in out if r.doc_id == 3]
    assert repeated[0] == repeated[1]
    assert {r.source: r.target for r in out}["empty"] == 0
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    taken = {}
    for r in mixed.collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + 1
    for r in out:
        times = 2 if r.doc_id == 3 else 1
        assert taken.get(r.doc_id, 0) == r.copies * times
    assert mixing.mix_sizes(docs.limit(0)).count() == 0
    assert mixing.mix_documents(docs.limit(0)).count() == 0


def test_nothing_but_empty_texts(spark):
    docs = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in mixing.mix_sizes(docs).collect()] == [(0.0, 0), (0.0, 0)]
