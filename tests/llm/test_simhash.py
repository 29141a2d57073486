"""Fingerprints and components against brute force, and the defined edge cases."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pulsemart.llm import queries, simhash
from pulsemart.llm.components import connected_components


def fingerprint(text, shingle=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(len(words) - shingle + 1, 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def components(ids, fps, radius=2):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                parent[root(i)] = root(j)
    groups = {}
    for i, doc in enumerate(ids):
        groups.setdefault(root(i), []).append(doc)
    smallest = {r: min((d for d in g if d is not None), default=None) for r, g in groups.items()}
    return [smallest[root(i)] for i in range(len(ids))]


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    fps = [fingerprint(d.text) for d in docs]
    expected = sorted(zip([d.doc_id for d in docs], [f"{f:016x}" for f in fps], components([d.doc_id for d in docs], fps)))
    got = sorted(tuple(r) for r in queries.op8_simhash(spark, sf_dir).collect())
    assert got == expected
    assert any(r[0] != r[2] for r in got)


def test_odd_rows(spark):
    texts = [None, "", " \t\n", "one", "ONE", "É one", "a b", "a  b\x0b", "x " * 50_000, "x " * 50_000, "tie", "tie"]
    rows = [(i if i != 5 else None, t, "clash", 1) for i, t in enumerate(texts)] + [(3, "one", "clash", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    got = simhash.simhash_components(docs).select("doc_id", "fingerprint", "component_id").collect()
    fps = [fingerprint(r[1]) for r in rows]
    ids = [r[0] for r in rows]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(zip(ids, [f"{f:016x}" for f in fps], components(ids, fps)), key=key)
    kept = simhash.drop_near_duplicates(docs).collect()
    assert kept[0].asDict().keys() == {"doc_id", "text", "fp", "component_id"}
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted({c for c in components(ids, fps) if c is not None})
    assert simhash.simhash_components(docs.limit(0)).count() == 0
    assert simhash.drop_near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_blocks_find_all_links(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    values = [int(b) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 5), replace=False)) for b in base for _ in range(6)]
    values = np.unique(np.array(values, dtype=np.uint64))
    links = simhash.block_links(values, radius)
    assert all((int(values[a]) ^ int(values[b])).bit_count() <= radius for a, b in links)
    assert len(links) < len(values)
    got = list(range(len(values)))

    def root(x):
        while got[x] != x:
            x = got[x]
        return x

    for a, b in links:
        got[root(a)] = root(b)
    want = components(list(range(len(values))), [int(v) for v in values], radius)
    groups = {}
    for i in range(len(values)):
        groups.setdefault(root(i), []).append(i)
    assert {frozenset(g) for g in groups.values()} == {
        frozenset(i for i in range(len(values)) if want[i] == w) for w in set(want)
    }


def test_large_blocks_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 16)
    near = [(1 << a) | (1 << b) for a in range(32, 48) for b in range(a)]
    fps = spark.createDataFrame([(v,) for v in near], "fp long")
    member = connected_components(simhash.fingerprint_links(fps, 2))
    found = {r.node: r.component for r in member.collect()}
    want = components(near, near)
    assert [found[v] for v in near] == want


def test_long_chain_is_one_component(spark):
    links = spark.range(500).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    rows = connected_components(links).collect()
    assert len(rows) == 501 and {r.component for r in rows} == {0}
    assert connected_components(links.limit(0)).count() == 0
