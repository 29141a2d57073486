"""License scans: oracle, canonical forms, notices, edge cases."""

import textwrap
from pathlib import Path

import pytest

from pulsemart.llm import licenses, oracle, queries
from pulsemart.llm.licenses import KNOWN_LICENSES
from tests.compare import connect, duck_rows, spark_rows


def test_equals_sql(spark, sf_dir):
    df = queries.op3_licenses(spark, sf_dir)
    assert spark_rows(df) == duck_rows(connect(sf_dir), oracle.ORACLES["op3_licenses"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_entire_texts_in_other_forms(spark):
    mit = KNOWN_LICENSES[0][1]
    bsd = next(t for n, t in KNOWN_LICENSES if n == "BSD-3-Clause")
    texts = [
        mit, mit.upper(), mit.replace("\n", "\r\n   "), "Copyright (c) 2020 Someone\n\n" + mit,
        mit.replace("License", "Licence").replace(",", " ,"), mit + "\nand more", mit[:-40], bsd.replace("copyright holder", "copyright owner"),
        "  * Copyright 2001-2003, A & B\n * All rights reserved.\n" + bsd, "© 2024 X\n" + bsd.replace('"', "``"), "x " * 100_000,
        None, "", " ... ", "Copyright 2020 only", mit, mit,
    ]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, license int")
    got = licenses.scan_licenses(docs, licenses.default_licenses(spark)).collect()
    found = {r.doc_id: r.license for r in got}
    assert len(got) == len(texts)
    assert [found[i] for i in range(5)] == ["MIT"] * 5
    assert found[5] is found[6] is found[10] is None
    assert found[7] == found[8] == found[9] == "BSD-3-Clause"
    assert all(r.digest is None and r.license is None for r in got if r.doc_id in (11, 12, 13, 14))
    assert licenses.scan_licenses(docs.limit(0), licenses.default_licenses(spark)).count() == 0


def test_spellings(spark):
    pairs = [
        ("whilst we recognise the organisations", "while we recognize the organizations"), ("favour & colour", "favor and color"),
        ("sub-licence", "sublicense"), ("the fulfilment", "the fulfillment"), ("modelling", "modeling"), ("judgement", "judgment"),
        ("99 per cent", "99 percent"), ("https://x.org", "http://x.org"), ("centre", "center"), ("wilful", "willful"), ("catalogue", "catalog"),
    ]
    rows = spark.createDataFrame(pairs, "a string, b string")
    for r in rows.select("a", "b", licenses.canonical(rows.a).alias("x"), licenses.canonical(rows.b).alias("y")).collect():
        assert r.x == r.y, r


def test_names_of_equal_texts(spark):
    known = spark.createDataFrame([("b", "Some Terms"), ("a", "some terms!"), ("c", ""), ("d", None)], "license string, text string")
    docs = spark.createDataFrame([(1, "SOME TERMS"), (2, ""), (None, "some terms")], "doc_id long, text string")
    assert {r.doc_id: r.license for r in licenses.scan_licenses(docs, known).collect()} == {1: "a", 2: None, None: "a"}


def test_notices(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = {(r.doc_id, r.license) for r in licenses.scan_notices(docs, licenses.default_licenses(spark)).collect()}
    want = set()
    notices = {t: n for n, t in KNOWN_LICENSES if "\n" not in t}
    for r in docs.collect():
        want |= {(r.doc_id, notices[line]) for line in r.text.split("\n") if line in notices}
    assert want and found == want


def test_wrapped_and_one_line_forms_of_every_known_text(spark):
    rows, want = [], {}
    for n, (name, text) in enumerate(KNOWN_LICENSES):
        joined = " ".join(text.split())
        forms = ["\n".join(textwrap.wrap(joined, w, break_long_words=False, break_on_hyphens=False)) for w in (12, 20, 33, 47, 61, 79)] + [joined, joined.upper(), joined.title()]
        forms += [f"Copyright (c) 2020 Jane Q. Doe. {joined}", f"Copyright 2019-2021 J. Doe <j.doe@x.org>\n{joined}"]
        forms += [f"Copyright Jane Doe and Others\n\n{joined}", f"/* © Foo GmbH. All rights reserved.\n{joined}"]
        for m, form in enumerate(forms):
            rows.append((100 * n + m, form))
            want[100 * n + m] = name
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.license for r in licenses.scan_licenses(docs, licenses.default_licenses(spark)).collect()}
    assert got == want


@pytest.mark.parametrize("name,file", [("Apache-2.0", "Apache-2.0"), ("GPL-3.0", "GPL-3"), ("LGPL-2.1", "LGPL-2.1"), ("MPL-2.0", "MPL-2.0")])
def test_full_texts(spark, name, file):
    path = Path("/usr/share/common-licenses") / file
    if not path.exists():
        pytest.skip("no copy of the text here")
    text = path.read_text()
    docs = spark.createDataFrame([(1, text), (2, text.upper()), (3, text[:-200])], "doc_id long, text string")
    got = {r.doc_id: r.license for r in licenses.scan_licenses(docs, licenses.default_licenses(spark)).collect()}
    assert got == {1: name, 2: name, 3: None}


def test_statements_of_copyright_only(spark):
    kept = ["copyright notice and this", "the Copyright Holders or", "copyright law applies", "(c) You must retain", "COPYRIGHT HOLDERS AND CONTRIBUTORS"]
    gone = ["Copyright 2020 X", "© X", "Copyright (c) X", "(c) 2020 X", "Copyright [yyyy] [name]", "Copyright Ann Lee", "All Rights Reserved."]
    rows = spark.createDataFrame([(t,) for t in kept + gone], "t string")
    forms = [r.c for r in rows.select(licenses.canonical(rows.t).alias("c")).collect()]
    assert all(forms[: len(kept)]) and not any(forms[len(kept) :])


def test_notices_of_odd_rows(spark):
    mit, cc = "Released under the MIT License.", "licensed under cc by 4.0"
    rows = [(1, f"{mit}\n{cc}\n{mit}"), (1, mit), (None, cc), (2, None), (3, ""), (4, "x\n" * 50_000 + mit), (5, f"not {mit}"), (6, mit)]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, notices string")
    found = licenses.scan_licenses(docs, licenses.default_licenses(spark)).collect()
    got = sorted(((r.doc_id or 0, r.notices or "") for r in found))
    assert got == [(0, "CC-BY-4.0"), (1, "CC-BY-4.0,MIT"), (1, "MIT"), (2, ""), (3, ""), (4, "MIT"), (5, ""), (6, "MIT")]
    assert {r.doc_id for r in found if r.license} == {None, 1, 6}
    names = licenses.scan_notices(docs, licenses.default_licenses(spark)).collect()
    assert len(names) == 5 and {r.doc_id for r in names} == {None, 1, 4, 6}
