"""Pieces of batches give what the whole batch gives."""

import numpy as np
import pyarrow as pa
import pytest

from pulsemart.llm import decontaminate, ngrams, quality, text
from pulsemart.llm.simhash import fingerprints

TEXTS = ["Ünder THE sea", "the sea the SEA", "", "É b C d É", " x\x0by ", "Last words, 12 of them"] * 5
BATCHES = [pa.RecordBatch.from_arrays([pa.array(t, kind)], ["text"]) for t in (TEXTS, [None, *TEXTS]) for kind in (pa.string(), pa.large_string())]


@pytest.mark.parametrize("batch", BATCHES)
def test_slices_read_their_own_bytes(batch):
    pieces = list(text.pieces([batch.slice(1)], limit=30))
    assert len(pieces) > 5
    want = [t or "" for t in batch.column("text").to_pylist()[1:]]
    assert [t for p in pieces for t in text.filled(p.column("text")).to_pylist()] == want
    fresh = pa.array(want)
    assert np.concatenate([fingerprints(p.column("text")) for p in pieces]).tolist() == fingerprints(fresh).tolist()
    words = [w for p in pieces for w in text.split_words(p.column("text"))[0].to_pylist()]
    assert words == text.split_words(fresh)[0].to_pylist()
    coded = [text.coded_words(p.column("text"), lower=True) for p in pieces]
    assert [c.vocabulary[int(k)].as_py() for c in coded for k in c.codes] == [w.lower() for w in words]
    assert np.concatenate([quality.encode(p.column("text"))[0] for p in pieces]).tolist() == quality.encode(fresh)[0].tolist()
    kinds = np.concatenate([decontaminate.Templates(p.column("text")).kind for p in pieces])
    assert kinds.tolist() == decontaminate.Templates(fresh).kind.tolist()
    grams = np.concatenate([ngrams.Block(p.column("text"), 1).hashes[0] for p in pieces])
    assert set(grams.tolist()) == set(ngrams.Block(fresh, 1).hashes[0].tolist())


def test_words_are_split_at_the_six_white_spaces_only():
    shown = "a\x1cb c\td\ne\x0bf\x0cg\rh\u00a0i\u2003j"
    assert text.split_words(pa.array([shown]))[0].to_pylist() == ["a\x1cb", "c", "d", "e", "f", "g", "h\u00a0i\u2003j"]
