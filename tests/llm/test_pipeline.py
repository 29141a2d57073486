"""The pipeline: each stage against a plain version on its own input, odd rows, registration."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from pulsemart.llm import decontaminate, langid, mixing, simhash, toxicity
from pulsemart.session import cut_lineage
from tests.llm.test_simhash import components, fingerprint

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    docs = corpus_pipeline.table(spark, sf_dir, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(cut_lineage(stage(spark, out[-1], sf_dir), name))
        assert out[-1].columns == COLUMNS
    return {name: (a.collect(), b.collect()) for (name, _), a, b in zip(corpus_pipeline.STAGES, out, out[1:])}


def ids(rows):
    return {r.doc_id for r in rows}


def test_registered():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "toxicity", "near_dedup", "decontaminate", "mix"]
    queries = entry.queries()
    found = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries if n.startswith("op"))
    assert found == list(range(1, 14)) and "pipeline" in queries
    assert set(entry.LLM_ORACLES) <= set(queries)


def test_language_keeps_documents_with_letters(steps):
    before, after = steps["language"]
    assert len(before) - len(after) <= 0.002 * len(before)
    assert {r.doc_id: r for r in before}.items() >= {r.doc_id: r for r in after}.items()


def test_toxicity_agrees_with_held_out_labels(steps, spark, sf_dir):
    before, after = steps["toxicity"]
    labels = {r.doc_id: r.toxic for r in corpus_pipeline.table(spark, sf_dir, "labels").collect()}
    kept = ids(after)
    known = [(labels[r.doc_id], r.doc_id in kept) for r in before if r.doc_id in labels]
    assert sum(toxic != stays for toxic, stays in known) / len(known) > 0.95
    assert all(stays for toxic, stays in known if not toxic)


def test_one_of_each_group_stays(steps):
    before, after = steps["near_dedup"]
    fps = [fingerprint(r.text, corpus_pipeline.NEAR_SHINGLE) for r in before]
    want = components([r.doc_id for r in before], fps, corpus_pipeline.NEAR_BITS)
    assert ids(after) == set(want) and len(after) == len(set(want)) < len(before)


def test_benchmark_documents_go(steps, spark, sf_dir):
    before, after = steps["decontaminate"]
    items = [re.sub(r"\W+", " ", r.text).lower() for r in corpus_pipeline.table(spark, sf_dir, "benchmark").collect()]
    whole = {r.doc_id for r in before if any(i.strip() in re.sub(r"\W+", " ", r.text).lower() for i in items)}
    assert whole and whole <= ids(before) - ids(after)
    assert len(ids(before) - ids(after) - whole) <= 2


def test_mix_repeats_whole_documents(steps, spark):
    before, after = steps["mix"]
    sizes = {r.doc_id: r for r in mixing.mix_sizes(spark.createDataFrame(before)).collect()}
    times = {}
    for r in after:
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert all(times.get(d, 0) == s.copies <= 3 for d, s in sizes.items())
    for source in {s.source for s in sizes.values()}:
        own = [s for s in sizes.values() if s.source == source]
        assert sum(s.taken for s in own) == pytest.approx(own[0].target, rel=0.7)


def test_stages_on_odd_rows(spark, sf_dir):
    texts = [None, "", " ", "The and attion to thanedble", "The and attion to thanedble", "the " * 50_000, "12 34", "moron idiot scum"]
    rows = [(i, t, None, None, None, "x", 1) for i, t in enumerate(texts)] + [(None, "of the and", "en", "s", 1, "x", 1)]
    rows += [(3, texts[3], None, None, None, "x", 1)]
    names = ["fp", "kept_id", "Hit_ID", "mix_of", "mix_rate", "rate"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, fp string, " + ", ".join(f"{n} int" for n in names[1:])
    rows = [(*r, *[1] * 4) for r in rows]
    clean = corpus_pipeline.table(spark, sf_dir, "documents").withColumn("fp", F.lit("y"))
    clean = clean.withColumns({n: F.lit(2) for n in names[1:]})
    odd = spark.createDataFrame(rows, schema)
    docs = cut_lineage(clean.unionByName(odd), "odd")
    for _, stage in corpus_pipeline.STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), "odd")
        assert docs.columns == clean.columns
    only = {r.doc_id for r in docs.where("fp = 'x'").collect()}
    assert not only & {0, 1, 2, 6, 7}
    empty = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = cut_lineage(stage(spark, empty, sf_dir), "odd")
        assert empty.count() == 0


def test_operators_are_the_library_ones():
    assert {f.__module__ for f in (langid.keep_known_languages, toxicity.drop_toxic, simhash.drop_near_duplicates)} == {
        "pulsemart.llm.langid", "pulsemart.llm.toxicity", "pulsemart.llm.simhash",
    }
    assert decontaminate.drop_contaminated.__module__ == "pulsemart.llm.decontaminate"
