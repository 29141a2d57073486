"""Stupid-backoff scores of whole documents from n-gram counts of the whole corpus.

Documents are packed into blocks. Every block hands each of its different n-grams once,
with its count in the block, to the partition that owns the n-gram's hash; there the
counts of all blocks are summed and go back to the blocks that asked, and each block sums
the scores of its documents. What is shuffled are sorted arrays of hashes, stored as
differences, so that an n-gram costs about five bytes and not a row, and a frequent
n-gram reaches its partition once per block and not once per occurrence.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.decontaminate import string_hashes
from pulsemart.llm.langid import mixed
from pulsemart.llm.mixing import words as word_count
from pulsemart.llm.text import coded_words, filled, pieces

ORDER = 3
BACKOFF = 0.4
# n-grams of order two and more that occur less often in the corpus are not in its tables: none.
LEAST = 1
# Bits of an n-gram's hash; two different ones meet with probability 2^-56.
HASH_BITS = 56
# Text of a block, and n-grams of an order in a partition of the count tables, on average.
BLOCK_BYTES = 8 << 20
PARTITION_WORDS = 1 << 20
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def packed(values: np.ndarray) -> bytes:
    """Whole numbers by byte position, compressed: leading zero bytes cost nothing."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T.copy()
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 8 * count, codec="zstd", asbytes=True), dtype=np.uint8)
    return planes.reshape(8, -1).T.copy().view("<u8").ravel()


class Block:
    """The n-grams of some texts: per order the sorted different hashes, their counts, and each word's index (-1: none)."""

    def __init__(self, texts: pa.Array, order: int):
        words = coded_words(texts, lower=True)
        self.starts = words.starts
        code = mixed(string_hashes(words.vocabulary))[words.codes]
        place = np.arange(len(code)) - self.starts[:-1][words.texts] if len(code) else np.zeros(0, dtype=np.int64)
        self.hashes, self.counts, self.index = [], [], []
        total = np.zeros(len(code), dtype=np.uint64)
        for k in range(1, order + 1):
            # The n-gram that ends at a word is the one that ends before it, and the word.
            total = code if k == 1 else np.concatenate([code[:1], total[:-1] * MULTIPLIER + code[1:]])
            at = np.flatnonzero(place >= k - 1)
            gram = mixed(total[at] + np.uint64(k)) >> np.uint64(64 - HASH_BITS)
            unique, inverse, counts = np.unique(gram, return_inverse=True, return_counts=True)
            index = np.full(len(code), -1, dtype=np.int64)
            index[at] = inverse
            self.hashes.append(unique)
            self.counts.append(counts)
            self.index.append(index)

    def scores(self, corpus: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
        """Per text the sum of log scores without the corpus size, and how many words fell back to single words.

        ``corpus[k]`` has the corpus counts of ``hashes[k]``.
        """
        n = len(self.index[0])
        score = np.zeros(n)
        open_ = np.arange(n)
        for k in range(len(self.hashes) - 1, 0, -1):
            index = self.index[k][open_]
            count = np.where(index >= 0, corpus[k][np.maximum(index, 0)] if len(corpus[k]) else 0, 0)
            kept = count >= least
            word = open_[kept]
            score[word] += np.log(count[kept] / corpus[k - 1][self.index[k - 1][word - 1]])
            open_ = open_[~kept]
            # A text's first words have no longer n-gram to fall back from.
            score[open_[self.index[k][open_] >= 0]] += np.log(BACKOFF)
        score[open_] += np.log(corpus[0][self.index[0][open_]])
        single = np.zeros(n)
        single[open_] = 1
        owner = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        texts = len(self.starts) - 1
        return np.bincount(owner, weights=score, minlength=texts), np.bincount(owner, weights=single, minlength=texts)


def pack_documents(docs: DataFrame, id_column: str) -> DataFrame:
    """(block, ids, sizes, texts): a row per block, its texts in one compressed value."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, piece in enumerate(pieces(batches, limit=BLOCK_BYTES)):
            values = [t.encode() for t in filled(piece.column("text")).to_pylist()]
            columns = [
                pa.array([(task << 32) + number]),
                pa.array([piece.column("doc_id").to_pylist()], pa.list_(piece.schema.field("doc_id").type)),
                pa.array([[len(v) for v in values]], pa.list_(pa.int64())),
                pa.array([pa.compress(b"".join(values), codec="zstd", asbytes=True)], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["block", "ids", "sizes", "texts"])

    kind = docs.schema[id_column].dataType.simpleString()
    narrow = docs.select(F.col(id_column).alias("doc_id"), "text")
    return narrow.mapInArrow(pack, f"block long, ids array<{kind}>, sizes array<long>, texts binary")


def block_texts(sizes: list[int], data: bytes) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    raw = pa.decompress(data, int(offsets[-1]), codec="zstd") if offsets[-1] else pa.py_buffer(b"")
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), raw)


def score_documents(
    docs: DataFrame, order: int = ORDER, least: int = LEAST, id_column: str = "doc_id"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, words, score, per_word.

    Words are what white space separates, in lower case. A word's score is its n-gram's
    count over its context's count if the n-gram occurs at least ``least`` times in all of
    ``docs``, else ``BACKOFF`` times the score with one word less of context, and at last
    its count over the number of all words. ``score`` is the sum of the logarithms,
    ``per_word`` its mean; both are 0 and null for null texts and texts without words.
    Repeated rows are counted and come back as often as they are there; an empty table
    gives no rows; other columns are ignored.
    """
    total = docs.agg(F.coalesce(F.sum(word_count(F.col("text"))), F.lit(0))).first()[0]
    bits = max(int(np.ceil(np.log2(max(total / PARTITION_WORDS, 1)))), 0)
    kind = docs.schema[id_column].dataType.simpleString()
    blocks = pack_documents(docs, id_column)

    def hand_out(block: pa.Table) -> pa.Table:
        rows = []
        for number, sizes, texts in zip(*(block.column(c).to_pylist() for c in ("block", "sizes", "texts"))):
            grams = Block(block_texts(sizes, texts), order)
            for k, (hashes, counts) in enumerate(zip(grams.hashes, grams.counts)):
                part = (hashes >> np.uint64(HASH_BITS - bits)).astype(np.int64) if bits else np.zeros(len(hashes), dtype=np.int64)
                first = np.flatnonzero(np.diff(part, prepend=-1))
                for a, b in zip(first, [*first[1:], len(part)]):
                    steps = np.diff(hashes[a:b], prepend=np.uint64(0))
                    rows.append((int(part[a]), number, k, b - a, packed(steps), packed(counts[a:b])))
        columns = zip(*rows) if rows else [[]] * 6
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["part", "block", "k", "n", "steps", "counts"])

    handed = blocks.groupBy("block").applyInArrow(
        hand_out, "part long, block long, k int, n long, steps binary, counts binary"
    )

    def add_up(part: pa.Table) -> pa.Table:
        out = []
        column = {c: part.column(c) for c in part.column_names}
        for k in range(order):
            rows = np.flatnonzero(column["k"].to_numpy() == k)
            if not len(rows):
                continue
            sizes = column["n"].to_numpy()[rows]
            hashes = np.concatenate([np.cumsum(unpacked(column["steps"][int(r)].as_py(), int(n))) for r, n in zip(rows, sizes)])
            counts = np.concatenate([unpacked(column["counts"][int(r)].as_py(), int(n)) for r, n in zip(rows, sizes)])
            _, inverse = np.unique(hashes, return_inverse=True)
            sums = np.bincount(inverse, weights=counts).astype(np.uint64)[inverse]
            ends = np.cumsum(sizes)
            for r, a, b in zip(rows, ends - sizes, ends):
                out.append((column["block"][int(r)].as_py(), k, column["part"][int(r)].as_py(), int(b - a), packed(sums[a:b])))
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        columns = zip(*out) if out else [[]] * 5
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["block", "k", "part", "n", "sums"])

    tables = handed.groupBy("part").applyInArrow(add_up, "block long, k int, part long, n long, sums binary")

    def score(counted: pa.Table, block: pa.Table) -> pa.Table:
        rows = sorted(zip(*(counted.column(c).to_pylist() for c in ("k", "part", "n", "sums"))), key=lambda r: r[:2])
        corpus = [
            np.concatenate([np.zeros(0), *[unpacked(s, n).astype(float) for j, _, n, s in rows if j == k]]) for k in range(order)
        ]
        ids, sizes, texts = (block.column(c)[0].as_py() for c in ("ids", "sizes", "texts"))
        grams = Block(block_texts(sizes, texts), order)
        sums, single = grams.scores(corpus, least)
        columns = [
            pa.array(ids, block.schema.field("ids").type.value_type),
            pa.array(np.diff(grams.starts).astype(np.int64)),
            pa.array(sums.astype(float)),
            pa.array(single.astype(float)),
        ]
        return pa.table(columns, names=["doc_id", "words", "sums", "single"])

    scored = tables.groupBy("block").cogroup(blocks.groupBy("block")).applyInArrow(
        score, f"doc_id {kind}, words long, sums double, single double"
    )
    value = F.when(F.col("words") > 0, F.col("sums") - F.col("single") * F.log(F.lit(float(max(total, 1))))).otherwise(0.0)
    return scored.select("doc_id", "words", value.alias("score")).withColumn(
        "per_word", F.when(F.col("words") > 0, F.col("score") / F.col("words"))
    )
