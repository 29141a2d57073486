"""Encoding, spans and decoding against the tokenizer library."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from pulsemart.llm import queries, sentencepieces
from pulsemart.llm.queries import table

ODD = ["Hello wörld", " a", "  ", "", "a\x00b", "x日本𝒳y", "▁▁a ▁ b", "a▁ b", "<s> </s><0x41>\n\n", "", "tail  ", "\n"]
LETTERS = "abcde  \n\t▁éß日本𝒳🙂ABC.,<>0x41s/ ing"


def with_normaliser(data: bytes, spec: bytes) -> bytes:
    """A model file's bytes with another normaliser."""

    def number(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    parts = [f for f in sentencepieces.message_fields(data) if f[0] != sentencepieces.NORMALISER]
    return b"".join(number(k << 3 | 2) + number(len(v)) + v for k, v in [*parts, (sentencepieces.NORMALISER, spec)])


@pytest.fixture(scope="module")
def plain():
    with open(queries.tokenizer_path(), "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def mapped(plain):
    """With a compiled character map and trimmed spaces."""
    spec = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_normalizer_spec()
    return with_normaliser(plain, spec)


@pytest.fixture(scope="module", params=["plain", "mapped"])
def both(request):
    data = request.getfixturevalue(request.param)
    return sentencepieces.parse_piece_model(data), sentencepiece.SentencePieceProcessor(model_proto=data)


def compare(model, library, texts):
    ids, begins, ends, starts = model.encode(pa.array(texts, pa.string()))
    lists = [ids[a:b].tolist() for a, b in zip(starts, starts[1:])]
    for i, text in enumerate(texts):
        found = library.encode(text or "", return_type="proto").pieces
        assert lists[i] == [p.id for p in found], text
        own = list(zip(begins[starts[i] : starts[i + 1]].tolist(), ends[starts[i] : starts[i + 1]].tolist()))
        assert own == [(p.begin, p.end) for p in found], text
    assert model.decode(ids, starts) == [library.decode(x) for x in lists]


def test_odd_and_random_texts(both):
    some = random.Random(3)
    extra = "ＡＢ①ﬁｶﾞ¨ À ​　…" if both[0].characters else ""
    texts = ["".join(some.choice(LETTERS + extra) for _ in range(some.randint(0, 60))) for _ in range(1500)]
    compare(*both, [*ODD, None, *texts])


def test_long_stretches_and_texts(both):
    some = random.Random(4)
    words = "".join(some.choice("abcdefgh") for _ in range(5000))
    compare(*both, [words, "the same words again and " * 3000, "=" * 3000, " " * 700, "日本語" * 500])


def test_real_texts(spark, sf_dir, both):
    texts = [r.text for r in table(spark, sf_dir, "documents").select("text").collect()]
    compare(*both, texts)


def test_memory_of_stretches_changes_nothing(plain, monkeypatch):
    model = sentencepieces.parse_piece_model(plain)
    texts = pa.array(["one two three", "two three four", "one two three"] * 5)
    first = [x.tolist() for x in model.encode(texts)]
    monkeypatch.setattr(sentencepieces, "REMEMBERED", 1)
    for _ in range(3):
        assert [x.tolist() for x in model.encode(texts)] == first
    assert len(model.remembered.known) == 0


def test_decoding_of_any_ids(plain):
    model = sentencepieces.parse_piece_model(plain)
    library = sentencepiece.SentencePieceProcessor(model_proto=plain)
    some = random.Random(5)
    for _ in range(2000):
        ids = [some.choice([0, 1, 2, 3, 68, 100, 229, 153, 132, 263, 500, 1000]) for _ in range(some.randint(0, 12))]
        assert model.decode(np.array(ids), np.array([0, len(ids)]))[0] == library.decode(ids), ids
    with pytest.raises(ValueError):
        model.decode(np.array([40000]), np.array([0, 1]))


def test_bytes_that_are_no_text(plain):
    """A byte that belongs to no character counts as a replacement sign, and spans stay those of the source."""
    model = sentencepieces.parse_piece_model(plain)
    raw = b"a\xff\xe2\x96 b"
    offsets = pa.py_buffer(np.array([0, len(raw)], np.int64))
    texts = pa.LargeStringArray.from_buffers(1, offsets, pa.py_buffer(raw))
    ids, begins, ends, starts = model.encode(texts)
    assert model.decode(ids, starts) == ["a��� b"]
    assert int(ends[-1]) == len(raw)


def test_models_of_other_kinds_are_refused(plain):
    fields = list(sentencepieces.message_fields(plain))
    trainer = next(v for k, v in fields if k == sentencepieces.TRAINER)
    assert b"\x18\x02" in trainer
    with pytest.raises(ValueError):
        sentencepieces.parse_piece_model(plain.replace(trainer, trainer.replace(b"\x18\x02", b"\x18\x01", 1)))


def test_query_against_the_library(spark, sf_dir, plain):
    library = sentencepiece.SentencePieceProcessor(model_proto=plain)
    rows = {r.doc_id: r for r in queries.op13_sentencepiece(spark, sf_dir).collect()}
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for doc in docs:
        ids = library.encode(doc.text or "")
        row = rows[doc.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        assert row.bytes_covered == len((doc.text or "").encode())


def test_rows(spark, plain):
    """Null ids and texts, repeated rows, an empty table, columns with the names of the result."""
    model = sentencepieces.parse_piece_model(plain)
    schema = "doc_id long, text string, ids string, begins int, decoded string"
    docs = spark.createDataFrame(
        [(1, "one two", "x", 1, "y"), (1, "one two", None, None, None), (None, "é\n", "x", 1, "y"), (2, None, "x", 1, "y"), (3, "", "x", 1, "y")],
        schema,
    )
    encoded = sentencepieces.encode_documents(docs, model)
    assert encoded.columns == ["doc_id", "ids", "begins", "ends"]
    texts = sorted((r.doc_id or 0, r.decoded) for r in sentencepieces.decode_documents(encoded, model).collect())
    assert texts == [(0, "é\n"), (1, "one two"), (1, "one two"), (2, ""), (3, "")]
    both = sentencepieces.encode_documents(docs, model, decoded=True)
    assert sorted((r.doc_id or 0, r.decoded) for r in both.collect()) == texts
    extra = encoded.selectExpr("doc_id", "if(doc_id = 3, null, ids) ids", "'x' decoded")
    again = {(r.doc_id or 0): r[-1] for r in sentencepieces.decode_documents(extra, model).collect()}
    assert again == {0: "é\n", 1: "one two", 2: "", 3: None}
    assert sentencepieces.encode_documents(docs.limit(0), model).count() == 0
    assert sentencepieces.decode_documents(encoded.limit(0), model).count() == 0
