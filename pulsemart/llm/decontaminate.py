"""Benchmark decontamination by template windows, joined on hashes, with slot consistency.

A word becomes a placeholder of its type if it is a number, a unit or a name; everything
else is kept in lower case without the marks around it. Windows of such templates are
joined between documents and benchmark items. Where a question was copied with other
numbers or names, the slots of a window must still map one to one: the same benchmark
value always to the same document value, and back. A window that does not is left out,
others of the same alignment count.

Capitals tell names only in ordinary text. Each window therefore has a second hash that no
capital or full stop changes: names stay words, and where too few words would be left also
numbers and units do. So exact copies of any window are found in any case. At the start of a
sentence a capital may be a name or not: a third hash takes every capital for one, on both
sides alike, so questions that begin with a name are found under another.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.langid import mixed
from pulsemart.llm.text import coded_words, free_names, pieces, value_bytes
from pulsemart.session import cut_lineage

# Template words of a window; an item with fewer is one window, one below SHORTEST must be the whole document.
WINDOW = 13
SHORTEST = 5
# A window needs this share of words that are not placeholders; its second hash takes it word by word if it has less.
LITERAL = 0.45
# Bits of the table that sorts out document windows before the join: 8 MB whatever the benchmark's size.
TABLE_BITS = 26

LITERAL_WORD, NUMBER, UNIT, NAME = range(4)
TYPES = np.array(["", "number", "unit", "name"], dtype=object)
# Number words and units.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen "
    "sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety "
    "hundred thousand million billion"
).split()
UNITS = (
    "mm cm m km inch inches ft foot feet yard yards mile miles mg g kg gram grams kilogram kilograms oz ounce ounces "
    "lb lbs pound pounds ton tons ml l liter liters litre litres gallon gallons second seconds minute minutes hour "
    "hours day days week weeks month months year years cent cents dollar dollars euro euros percent kmh mph kph "
    "meter meters metre metres kilometer kilometers kilometre kilometres usd eur gbp degrees"
).split()


def word_kinds(vocabulary: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """For each word: its core, its type but for names, whether it is capitalised, whether it ends a sentence."""
    bare = pc.replace_substring_regex(vocabulary, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    core = pc.utf8_lower(bare)
    number = pc.or_(pc.match_substring_regex(core, r"^\p{Nd}[\p{Nd}.,:/]*(st|nd|rd|th|s)?$"), pc.is_in(core, pa.array(NUMBER_WORDS, core.type)))
    unit = pc.is_in(core, pa.array(UNITS, core.type))
    kind = np.where(_flags(number), NUMBER, np.where(_flags(unit), UNIT, LITERAL_WORD))
    capital = _flags(pc.match_substring_regex(bare, r"^\p{Lu}.*\p{Ll}"))
    ends = _flags(pc.match_substring_regex(vocabulary, r"[.!?:][^\p{L}\p{N}]*$"))
    return core, kind, capital, ends


def _flags(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).astype(bool)


def string_hashes(strings: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string's bytes."""
    if not len(strings):
        return np.zeros(0, dtype=np.uint64)
    lengths = pc.binary_length(strings).to_numpy(zero_copy_only=False).astype(np.int64)
    data = np.frombuffer(value_bytes(strings), dtype=np.uint8).astype(np.uint64)
    starts = np.cumsum(lengths) - lengths
    place = (np.arange(len(data)) - np.repeat(starts, lengths)).astype(np.uint64)
    total = np.zeros(len(strings), dtype=np.uint64)
    there = lengths > 0
    if there.any():
        total[there] = np.add.reduceat(mixed(data + (place << np.uint64(8)) + np.uint64(1)), starts[there])
    return mixed(total + lengths.astype(np.uint64))


class Templates:
    """Template words of some texts: hashes, types, cores; ``starts`` delimits the texts."""

    def __init__(self, texts: pa.Array):
        words = coded_words(texts)
        core, kind, capital, ends = word_kinds(words.vocabulary)
        self.vocabulary = core
        literal = string_hashes(core)
        codes, owner = words.codes, words.texts
        said = _flags(pc.not_equal(core, ""))[codes]
        first = np.diff(owner, prepend=-1) > 0
        # A capital in the middle of a sentence is a name; at its start it says nothing.
        after_end = np.concatenate([[True], ends[codes[:-1]]]) | first
        self.kind = np.where((kind[codes] == LITERAL_WORD) & capital[codes] & ~after_end, NAME, kind[codes])[said]
        self.codes = codes[said]
        self.literal = literal[self.codes]
        self.hashes = np.where(self.kind == LITERAL_WORD, self.literal, mixed(self.kind.astype(np.uint64)))
        # With every capital as a name, wherever it stands.
        self.any_kind = np.where((kind[codes] == LITERAL_WORD) & capital[codes], NAME, kind[codes])[said]
        self.starts = np.concatenate([[0], np.cumsum(said)])[words.starts]

    def windows(self, length: int) -> tuple[np.ndarray, ...]:
        """Start of each window, its hash, its second hash, whether that takes all words as they are, its third hash and whether it has one.

        What stands before a passage must not matter: the first word counts as it is, unless
        it is a number or a unit; for the third hash capitals alone count. Windows below
        SHORTEST are whole texts.
        """
        size = np.diff(self.starts)
        count = np.maximum(size - length + 1, 0) if length >= SHORTEST else (size == length).astype(np.int64)
        start = np.repeat(self.starts[:-1], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        valued = (self.kind == NUMBER) | (self.kind == UNIT)
        head = np.where(valued, self.hashes, self.literal)

        def rolled(first: np.ndarray, later: np.ndarray, start: np.ndarray = start, salt: int = 0) -> np.ndarray:
            total = mixed(first[start] + np.uint64(length + salt))
            for j in range(1, length):
                total = total * np.uint64(0x9E3779B97F4A7C15) + later[start + j]
            return mixed(total)

        before = np.concatenate([[0], np.cumsum(valued)])
        plain = 1 - (before[start + length] - before[start]) / length < LITERAL
        second = np.where(plain, rolled(self.literal, self.literal), rolled(head, head))
        # A third hash only where it says more than the first: a name at the start of a sentence or window.
        moved = np.concatenate([[0], np.cumsum(self.any_kind != self.kind)])
        words = np.concatenate([[0], np.cumsum(self.any_kind == LITERAL_WORD)])
        opens = self.any_kind[start] == NAME
        has = (opens | (moved[start + length] > moved[start])) & ((words[start + length] - words[start]) / length >= LITERAL)
        third = np.zeros(len(start), dtype=np.uint64)
        if length >= SHORTEST and has.any():
            every = np.where(self.any_kind == LITERAL_WORD, self.literal, mixed(self.any_kind.astype(np.uint64)))
            third[has] = rolled(every, every, start[has], WINDOW + 1)
        return start, rolled(head, self.hashes), second, plain, third, has & (length >= SHORTEST)

    def slots(self, start: int, length: int, names: bool = True, values: bool = True) -> list[str]:
        """type:value of the placeholders: names after the first word, numbers and units anywhere."""
        at = [
            i for i in range(start, start + length)
            if (names and i > start if self.kind[i] == NAME else values and self.kind[i] != LITERAL_WORD)
        ]
        return [f"{TYPES[self.kind[i]]}:{self.vocabulary[int(self.codes[i])].as_py()}" for i in at]

    def any_slots(self, start: int, length: int) -> list[str]:
        """The same with every capital as a name."""
        at = [i for i in range(start, start + length) if self.any_kind[i] != LITERAL_WORD]
        return [f"{TYPES[self.any_kind[i]]}:{self.vocabulary[int(self.codes[i])].as_py()}" for i in at]


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, item_words, length, at, hash, slots) for every window of every item."""

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            templates = Templates(piece.column("text"))
            items = piece.column("item_id").to_pylist()
            size = np.diff(templates.starts)
            rows = []
            for length in sorted({int(min(s, WINDOW)) for s in size if s}):
                start, hashes, second, plain, third, has = templates.windows(length)
                owner = np.searchsorted(templates.starts, start, side="right") - 1
                each = [h.view(np.int64).tolist() for h in (hashes, second, third)]
                for s, h, g, t, p, more, o in zip(start.tolist(), *each, plain.tolist(), has.tolist(), owner.tolist()):
                    if min(size[o], WINDOW) != length:
                        continue
                    at = s - int(templates.starts[o])
                    rows.append((items[o], int(size[o]), length, at, g, templates.slots(s, length, False, not p)))
                    if length < SHORTEST:
                        continue
                    if more:
                        rows.append((items[o], int(size[o]), length, at, t, templates.any_slots(s, length)))
                    literal = (templates.kind[s : s + length] == LITERAL_WORD).mean()
                    if h != g and literal >= LITERAL:
                        rows.append((items[o], int(size[o]), length, at, h, templates.slots(s, length)))
            if rows:
                names = ["item_id", "item_words", "length", "at", "hash", "slots"]
                types = [piece.schema.field("item_id").type, pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string())]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"item_id {kind}, item_words int, length int, at int, hash long, slots array<string>"
    return cut_lineage(
        benchmark.where("text IS NOT NULL").select("item_id", "text").mapInArrow(compute, schema), "benchmark-windows"
    )


def hash_table(windows: DataFrame) -> np.ndarray:
    """A bit for every leading part of a window hash that occurs, as words of 64 bits: a bounded size."""
    slot = F.shiftrightunsigned("hash", 64 - TABLE_BITS)
    word = F.shiftrightunsigned(slot, 6).alias("word")
    bit = F.expr(f"bit_or(shiftleft(1L, cast(shiftrightunsigned(hash, {64 - TABLE_BITS}) & 63 AS INT)))").alias("bits")
    rows = windows.groupBy(word).agg(bit).toArrow()
    table = np.zeros(1 << (TABLE_BITS - 6), dtype=np.uint64)
    if rows.num_rows:
        table[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return table


def document_windows(docs: DataFrame, lengths: list[int], table: np.ndarray) -> DataFrame:
    """(doc_id, text_hash, length, place, hash, slots) of the windows whose hash may be one of the benchmark's."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for piece in pieces(batches):
            templates = Templates(piece.column("text"))
            for length in lengths:
                start, hashes, second, plain, third, has = templates.windows(length)
                # A window without a name has one hash, and is asked for once.
                other, more = np.flatnonzero(hashes != second), np.flatnonzero(has)
                kind = np.repeat([0, 1, 2], [len(start), len(other), len(more)])
                plain = np.concatenate([plain & (hashes == second), plain[other], plain[more]])
                hashes = np.concatenate([hashes, second[other], third[more]])
                start = np.concatenate([start, start[other], start[more]])
                slot = hashes >> np.uint64(64 - TABLE_BITS)
                there = (table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)
                if not there.any():
                    continue
                start, hashes, plain, kind = start[there], hashes[there], plain[there], kind[there]
                owner = np.searchsorted(templates.starts, start, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id").take(pa.array(owner)),
                        piece.column("text_hash").take(pa.array(owner)),
                        pa.array(np.full(len(start), length, dtype=np.int32)),
                        pa.array((start - templates.starts[owner]).astype(np.int64)),
                        pa.array(hashes.view(np.int64)),
                        pa.array(
                            [
                                templates.any_slots(s, length) if k == 2 else templates.slots(s, length, k == 0, not p)
                                for s, k, p in zip(start.tolist(), kind.tolist(), plain.tolist())
                            ],
                            pa.list_(pa.string()),
                        ),
                    ],
                    ["doc_id", "text_hash", "length", "place", "hash", "slots"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    narrow = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return narrow.mapInArrow(
        compute, f"doc_id {kind}, text_hash long, length int, place long, hash long, slots array<string>"
    )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item it repeats: doc_id, item_id, windows, coverage, changed, text_hash.

    ``windows`` is the largest number of the item's windows found in one alignment,
    ``coverage`` their share, ``changed`` whether slots hold other values than the item's.
    A document is reported from one whole window on; an item of fewer than ``SHORTEST`` words
    only if the document is that item, in any case. Windows in which fewer than ``LITERAL`` of the
    words are no placeholders are found word for word only. Null and empty texts and items match
    nothing; rows that repeat an id and a text are reported once; a null id is kept as
    null. Without documents or items there are no rows. Other columns are ignored.
    """
    known = benchmark_windows(benchmark)
    lengths = sorted(r.length for r in known.select("length").distinct().collect())
    found = document_windows(docs, lengths, hash_table(known))
    pair = F.zip_with(F.col("b.slots"), F.col("d.slots"), lambda old, new: F.struct(old.alias("old"), new.alias("new")))
    matched = (
        found.alias("d")
        .join(known.alias("b"), (F.col("d.hash") == F.col("b.hash")) & (F.col("d.length") == F.col("b.length")))
        .select(
            "doc_id", "text_hash", "item_id", "item_words", F.col("b.length").alias("length"), "at",
            (F.col("place") - F.col("at")).alias("offset"), F.array_distinct(pair).alias("pairs"),
        )
    )
    one_to_one = (F.size(F.array_distinct("pairs.old")) == F.size("pairs")) & (
        F.size(F.array_distinct("pairs.new")) == F.size("pairs")
    )
    # A group is one alignment of one item: as many rows as the item has words, at most.
    aligned = matched.where(one_to_one).groupBy("doc_id", "text_hash", "item_id", "offset").agg(
        F.first("item_words").alias("item_words"),
        F.first("length").alias("length"),
        F.size(F.collect_set("at")).alias("windows"),
        F.max(F.exists("pairs", lambda p: p.old != p.new)).alias("changed"),
    )
    whole = F.col("item_words") - F.col("length") + 1
    return (
        aligned.groupBy("doc_id", "text_hash", "item_id")
        .agg(
            F.max("windows").alias("windows"),
            F.max(F.col("windows") / whole).alias("coverage"),
            F.min("changed").alias("changed"),
        )
        .select("doc_id", "item_id", "windows", "coverage", "changed", "text_hash")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that repeat a benchmark item, in the columns of ``docs``."""
    key, mark = free_names(docs.columns, "hit_id", "hit_text")
    hits = contaminated(docs, benchmark).select(F.col("doc_id").alias(key), F.col("text_hash").alias(mark))
    hits = cut_lineage(hits.distinct(), "contaminated")
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (F.xxhash64("text") == F.col(mark))
    return docs.join(hits, same, "left_anti")
