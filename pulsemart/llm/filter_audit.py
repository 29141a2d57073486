"""What each filter of a chain removes in every order of the filters.

Four filters look at a text alone, the fifth at all texts: it fails copies of a text with a
smaller id. A counting Bloom sketch of text hashes, counted in parts by the tasks and merged by
Spark's shuffle, clears the texts that surely occur once; only the others are compared in full.
Every document then is a mask of the filters it fails, and all orders are sums over masks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.text import coded_words, filled, pieces, value_bytes
from pulsemart.session import cut_lineage

FILTERS = "ABCDE"
REPEATS = 1 << FILTERS.index("E")
# Counters of the sketch for each row and how many of them a text uses: a unique text of many
# is taken for a possible repeat with a probability of about 0.0024.
COUNTERS_PER_ROW = 16
COUNTERS_OF_TEXT = 4
# All counters of a text are in one segment, as wide as Spark's bitmaps.
SEGMENT = 32768


@dataclass(frozen=True)
class FilterLimits:
    """Filters A to D fail a text with fewer words than ``words``, with a share of distinct words
    below ``distinct_percent``, with more capitals among its characters than ``capital_percent``,
    or with one of ``symbols``."""

    words: int = 100
    distinct_percent: int = 80
    capital_percent: int = 10
    symbols: str = "#$%&*|"


def failed_filters(texts: pa.Array, limits: FilterLimits = FilterLimits()) -> np.ndarray:
    """A mask per text, bit 0 for A to bit 3 for D. A null text is an empty one."""
    whole = filled(texts)
    n = len(whole)
    words = coded_words(whole)
    count = np.diff(words.starts)
    keys = np.unique(words.texts * max(len(words.vocabulary), 1) + words.codes)
    distinct = np.bincount(keys // max(len(words.vocabulary), 1), minlength=n)
    data = np.frombuffer(value_bytes(whole), dtype=np.uint8)
    offsets = np.frombuffer(whole.buffers()[1], dtype=np.int64)[: n + 1] if n else np.zeros(1, np.int64)

    def number_of(bytes_counted: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(bytes_counted[data], dtype=np.int64)])[offsets])

    byte = np.arange(256)
    capitals = number_of((byte >= 65) & (byte <= 90))
    characters = number_of((byte & 0xC0) != 0x80)
    symbols = number_of(np.isin(byte, np.frombuffer(limits.symbols.encode("ascii"), dtype=np.uint8)))
    fails = (
        count < limits.words,
        100 * distinct < limits.distinct_percent * count,
        100 * capitals > limits.capital_percent * characters,
        symbols > 0,
    )
    return sum(f.astype(np.int32) << i for i, f in enumerate(fails)) if n else np.zeros(0, np.int32)


def measured(docs: DataFrame, limits: FilterLimits = FilterLimits(), id_column: str = "doc_id") -> DataFrame:
    """(doc_id, part, mask, hashed, digest): a narrow row per row of ``docs``; texts go no further."""
    text = F.coalesce("text", F.lit(""))
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        F.coalesce("lang", F.lit("")).alias("part"),
        F.xxhash64(text).alias("hashed"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        text.alias("text"),
    )

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            mask = pa.array(failed_filters(piece.column("text"), limits), pa.int32())
            columns = [piece.column(c) for c in ("doc_id", "part", "hashed", "digest")]
            yield pa.RecordBatch.from_arrays([*columns, mask], ["doc_id", "part", "hashed", "digest", "mask"])

    return rows.mapInArrow(measure, f"doc_id {kind}, part string, hashed bigint, digest binary, mask int")


def _segment(segments: int) -> Column:
    return F.pmod("hashed", F.lit(segments))


def _counters() -> list[Column]:
    """Places of a text's counters in its segment, from other bits than the segment."""
    return [F.pmod(F.xxhash64("hashed", F.lit(i)), F.lit(SEGMENT)).cast("int") for i in range(COUNTERS_OF_TEXT)]


def repeat_sketch(rows: DataFrame) -> tuple[DataFrame, int]:
    """((segment, bitmap) of the counters that reach 2, number of segments) of a counting Bloom sketch of ``hashed``.

    Tasks count in parts, a counter at most once a row, and Spark adds the parts up by counter. The
    number of counters follows the number of rows, so the share of texts it clears stays the same.
    """
    segments = max(1, -(-rows.count() * COUNTERS_PER_ROW // SEGMENT))
    counted = (
        rows.select(_segment(segments).alias("segment"), F.explode(F.array_distinct(F.array(*_counters()))).alias("counter"))
        .groupBy("segment", "counter")
        .count()
    )
    twice = counted.where("count > 1").groupBy("segment").agg(F.bitmap_construct_agg(F.col("counter").cast("long")).alias("bitmap"))
    return cut_lineage(twice, "sketch"), segments


def possible_repeats(rows: DataFrame) -> DataFrame:
    """The rows whose text may occur again: all of whose counters reach 2. No repeated text is missing."""
    sketch, segments = repeat_sketch(rows)
    set_bits = F.lit(True)
    for place in _counters():
        byte = F.conv(F.hex(F.substring(F.col("bitmap"), (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        set_bits = set_bits & (F.getbit(byte, place % 8) == 1)
    placed = rows.withColumn("segment", _segment(segments))
    return placed.join(sketch, "segment").where(set_bits).drop("segment", "bitmap")


def first_ids(docs: DataFrame, suspects: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(digest, first_id) of every text that occurs more than once, compared in full.

    Texts whose hash no suspect has stay where they are; of the others each task sends one row
    for each different text, so a text with a third of all rows meets itself in as many rows as
    there are tasks.
    """
    hashes = cut_lineage(suspects.select("hashed").distinct(), "suspects")
    texts = docs.select(F.col(id_column).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    again = texts.withColumn("hashed", F.xxhash64("text")).join(hashes, "hashed", "left_semi")
    return (
        again.groupBy("text")
        .agg(F.min("doc_id").alias("first_id"), F.count("*").alias("rows"))
        .where("rows > 1")
        .select(F.unhex(F.sha2("text", 256)).alias("digest"), "first_id")
    )


def mask_counts(docs: DataFrame, labels: DataFrame, limits: FilterLimits = FilterLimits(), id_column: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic): documents by the filters they fail, and those labelled good or toxic.

    Rows are counted as if no text repeated; repeats then move from their mask to the one with
    filter E, as sums that are added.
    """
    marks = (
        labels.where(F.col(id_column).isNotNull())
        .groupBy(F.col(id_column).alias("doc_id"))
        .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    )
    rows = cut_lineage(measured(docs, limits, id_column).join(marks, "doc_id", "left"), "audit")
    suspects = cut_lineage(possible_repeats(rows), "repeats")
    repeats = suspects.join(first_ids(docs, suspects, id_column), "digest").where("doc_id > first_id")

    def counted(of: DataFrame) -> DataFrame:
        sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("good", "toxic")]
        return of.groupBy("part", "mask").agg(F.count("*").alias("n"), *sums)

    moved = counted(repeats)
    figures = ("n", "good", "toxic")
    taken = F.struct(F.lit(-1).alias("sign"), F.col("mask").alias("to"))
    put = F.struct(F.lit(1).alias("sign"), F.col("mask").bitwiseOR(F.lit(REPEATS)).alias("to"))
    changes = moved.select("part", F.inline(F.array(taken, put)), *figures).select(
        "part", F.col("to").alias("mask"), *[(F.col(c) * F.col("sign")).alias(c) for c in figures]
    )
    added = counted(rows).unionByName(changes).groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in figures])
    return added.where("n > 0")


def _bits(letters: Column) -> Column:
    """The mask of the filters a text of letters names."""
    bits = F.lit(0)
    for i, letter in enumerate(FILTERS):
        bits = bits + F.when(F.instr(letters, letter) > 0, 1 << i).otherwise(0)
    return bits


def order_report(counts: DataFrame) -> DataFrame:
    """From mask counts to a row per part, order of the filters and step; all of it sums over at most 32 masks a part."""
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = F.array(*[F.lit(i) for i in range(1, len(FILTERS) + 1)])
    placed = counts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(steps))
    placed = placed.withColumns(
        {
            "own": _bits(F.substring(F.col("filter_order"), F.col("step"), F.lit(1))),
            "earlier": _bits(F.substring(F.col("filter_order"), F.lit(1), F.col("step") - 1)),
        }
    )
    mask = F.col("mask")
    fails = mask.bitwiseAND(F.col("own")) != 0
    gone = mask.bitwiseAND(F.col("earlier")) != 0

    def total(condition: Column, value: Column = F.col("n")) -> Column:
        return F.sum(F.when(condition, value).otherwise(F.lit(0))).cast("long")

    # A document that fails k filters meets each of them first in one order of k.
    share = F.col("n") * F.floor(F.lit(120) / F.greatest(F.bit_count(mask), F.lit(1))).cast("long")
    return placed.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"),
        total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(mask == F.col("own")).alias("unique_fails"),
        total(fails & ~gone, F.col("good")).alias("good_lost"),
        total(fails & ~gone, F.col("toxic")).alias("toxic_lost"),
        total(fails, share).alias("shapley"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame, limits: FilterLimits = FilterLimits(), id_column: str = "doc_id") -> DataFrame:
    """All 120 orders of the five filters over ``docs``, by lang: what each step keeps and removes.

    A null text is an empty one, a null lang the part "". A null id has no smaller one and is
    none, and has no labels; rows with the same id and text are no repeats of each other, rows
    with the same id each count. A document is good or toxic if any of its labels says so;
    labels of other ids are left out. An empty table gives no rows. Other columns are ignored.
    """
    return order_report(cut_lineage(mask_counts(docs, labels, limits, id_column), "masks"))
