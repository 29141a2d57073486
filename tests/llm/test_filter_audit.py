"""The filter audit against a plain version and against its SQL."""

import random
import re
from collections import Counter
from itertools import permutations

import pyarrow as pa

from pulsemart.llm import filter_audit, oracle, queries
from tests.compare import connect, duck_rows, spark_rows

SCHEMA = "doc_id long, text string, lang string, source string, mask int, part string, hashed string, segment int"


def plain_fails(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return (
        (len(words) < 100)
        | (100 * len(set(words)) < 80 * len(words)) << 1
        | (100 * len(re.findall("[A-Z]", text)) > 10 * len(text)) << 2
        | bool(re.search(r"[#$%&*|]", text)) << 3
    )


def plain_audit(docs, labels):
    """Filters applied one after the other, document by document."""
    firsts = {}
    for doc in docs:
        if doc[0] is not None:
            firsts[doc[1] or ""] = min(doc[0], firsts.get(doc[1] or "", doc[0]))
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    rows = []
    for doc in docs:
        mask = plain_fails(doc[1])
        if doc[0] is not None and doc[0] > firsts[doc[1] or ""]:
            mask |= 16
        fails = {f for i, f in enumerate("ABCDE") if mask >> i & 1}
        rows.append((doc[2] or "", fails, doc[0] is not None and doc[0] in good, doc[0] is not None and doc[0] in toxic))
    out, shapley = {}, Counter()
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                removed = [r for r in left if letter in r[1]]
                left = [r for r in left if letter not in r[1]]
                failing = [r for r in own if letter in r[1]]
                out[part, "".join(order), step] = [
                    len(left), len(removed), len(failing) - len(removed), sum(r[1] == {letter} for r in own),
                    sum(r[2] for r in removed), sum(r[3] for r in removed),
                ]
                shapley[part, letter] += len(removed)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audit(spark, docs, labels):
    frame = spark.createDataFrame(docs, SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'x' text", "1 mask")
    rows = filter_audit.audit_filters(frame, marks).collect()
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in rows}


def doc(i, text, lang):
    return (i, text, lang, "s", 7, "p", "h", 1)


def test_against_a_plain_version(spark):
    some = random.Random(1)
    texts = [None, "", " \t", "Ünder É", "A B C", "x" * 50_000, "one # two"]
    for _ in range(60):
        words = [some.choice(["the", "The", "THE", "a|b", "é", "word", str(some.randint(0, 400))]) for _ in range(some.randint(1, 220))]
        texts.append(some.choice([" ", "\n", "\x0b "]).join(words))
    docs = [doc(i, some.choice(texts), some.choice(["en", "de", None, ""])) for i in range(300)]
    # Repeated rows, ids without order, null ids.
    docs += docs[:20] + [doc(-5, texts[8], "en"), doc(None, texts[8], "en"), doc(None, "only once", "fr")]
    some.shuffle(docs)
    labels = [(some.choice([None, some.randint(0, 310)]), some.choice([0, 1, None]), some.choice([0, 1, None])) for _ in range(300)]
    assert audit(spark, docs, labels) == plain_audit(docs, labels)


def test_empty_tables(spark):
    assert audit(spark, [], []) == {}
    docs = [doc(1, "a", "en")]
    assert audit(spark, docs, []) == plain_audit(docs, [])
    assert len(audit(spark, docs, [])) == 600


def test_masks():
    texts = [None, "", "A", "a b", "word " * 120, "é#", "É" * 3]
    assert filter_audit.failed_filters(pa.array(texts)).tolist() == [plain_fails(t) for t in texts]
    assert filter_audit.failed_filters(pa.array([], pa.string())).tolist() == []


def test_the_sketch_keeps_every_repeat_and_clears_most_others(spark):
    once = spark.range(30_000).selectExpr("id as doc_id", "xxhash64('once', id) as hashed")
    twice = spark.range(4_000).selectExpr("id + 30000 as doc_id", "xxhash64('twice', id % 2000) as hashed")
    hot = spark.range(6_000).selectExpr("id + 40000 as doc_id", "xxhash64('hot') as hashed")
    kept = {r.doc_id for r in filter_audit.possible_repeats(once.union(twice).union(hot)).collect()}
    assert kept >= set(range(30_000, 34_000)) | set(range(40_000, 46_000))
    assert sum(i < 30_000 for i in kept) < 300


def test_texts_of_one_hash_stay_apart(spark, monkeypatch):
    """With every counter shared and one hash for all texts, the full texts decide."""
    monkeypatch.setattr(filter_audit.F, "xxhash64", lambda *a: filter_audit.F.lit(7).cast("long"))
    docs = [doc(1, "a b", "en"), doc(2, "b a", "en"), doc(3, "a b", "en"), doc(4, "c", "en")]
    assert audit(spark, docs, []) == plain_audit(docs, [])


def test_query_against_its_sql(spark, sf_dir):
    query, sql = queries.QUERIES["op12_filter_audit"], oracle.ORACLES["op12_filter_audit"]
    assert spark_rows(query(spark, sf_dir)) == duck_rows(connect(sf_dir), sql)
