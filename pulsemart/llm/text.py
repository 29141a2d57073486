"""Whole texts in Arrow batches: slicing by bytes, words as codes into a vocabulary."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text handled at once by one task; a longer text is handled alone.
PIECE_BYTES = 2 << 20


def free_names(columns: Iterable[str], *names: str) -> list[str]:
    """The names, with underscores put before those that a column already has."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name in taken:
            name = f"_{name}"
        out.append(name)
    return out


def pieces(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(int(np.searchsorted(ends, before + limit, side="right")), first + 1)
            yield batch.slice(first, last - first)
            first = last


@dataclass
class Words:
    """The words of some texts: ``vocabulary[codes[i]]`` is word i, ``starts[d]:starts[d + 1]`` are those of text d."""

    codes: np.ndarray
    starts: np.ndarray
    vocabulary: pa.Array

    @property
    def texts(self) -> np.ndarray:
        """For each word, the index of its text."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))


def filled(texts: pa.Array) -> pa.Array:
    """Without nulls, and with offsets from 0: a slice that is only cast keeps its offsets, and
    `ascii_lower` then reads other bytes than its own."""
    whole = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(whole.buffers()[1], dtype=np.int64) if len(whole) else np.zeros(1)
    if whole.offset or offsets[0]:
        whole = whole.take(pa.array(np.arange(len(whole))))
    return whole


def value_bytes(strings: pa.Array) -> bytes:
    """All values of a large_string array without nulls, one after the other."""
    offsets = np.frombuffer(strings.buffers()[1], dtype=np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = strings.buffers()[2]
    return data[int(offsets[0]) : int(offsets[-1])].to_pybytes() if data is not None and len(strings) else b""


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words ``[^\\x20\\x09-\\x0D]+`` of the texts (null: none) and the first word's index of each text."""
    lists = pc.ascii_split_whitespace(filled(texts))
    words = lists.flatten()
    ends = lists.offsets.to_numpy()
    there = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    kept = np.concatenate([[0], np.cumsum(there)])
    return words.filter(pa.array(there)), kept[ends - ends[0]]


def coded_words(texts: pa.Array, lower: bool = False) -> Words:
    """Words as codes, so that work on a word is done once for each distinct word."""
    words, starts = split_words(pc.utf8_lower(filled(texts)) if lower else texts)
    if not len(words):
        return Words(np.zeros(0, dtype=np.int64), starts, pa.array([], pa.large_string()))
    coded = words.dictionary_encode()
    return Words(coded.indices.to_numpy().astype(np.int64), starts, coded.dictionary)
