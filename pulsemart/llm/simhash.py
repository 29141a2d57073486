"""SimHash near-duplicates: fingerprints of word shingles, linked by bit-sliced comparison.

Of ``radius + t`` bands, fingerprints within ``radius`` bits agree on ``t`` at least, so
every linked pair shares the bits of some choice of t bands, and each choice is one set
of blocks; t grows with the number of fingerprints, so that blocks stay small. In a block the fingerprints stand vertically, one
packed bit plane per fingerprint bit: a query is compared with all of them by adding
its difference planes into saturating carry-save counters, and words of 64
fingerprints whose counters all exceed the radius are left out of the later planes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.components import connected_components
from pulsemart.llm.text import filled, free_names, pieces, split_words, value_bytes
from pulsemart.session import cut_lineage

SEED = 42
SHINGLES_AT_ONCE = 1 << 18
# Fingerprints of one block that a task compares at once; larger blocks are dealt out as pairs of chunks.
CHUNK = 4096
# Blocks up to this size are compared together, a lane for each of their pairs.
SMALL = 32
# Fingerprints of a block, on average, as long as more bands can be asked to agree.
BLOCK = 16
MOST_BANDS = 4
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def bit_counts(hashes: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """For each text and bit, how many of the text's hashes have the bit set; ``text`` is ascending."""
    counts = np.zeros((texts, 64), dtype=np.int64)
    for a in range(0, len(hashes), SHINGLES_AT_ONCE):
        part, owner = hashes[a : a + SHINGLES_AT_ONCE], text[a : a + SHINGLES_AT_ONCE]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        counts[owner[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int32)
    return counts


def fingerprints(texts: pa.Array, shingle: int = 3) -> np.ndarray:
    """One 64-bit fingerprint per text; 0 where there is no word."""
    lowered = pc.ascii_lower(filled(texts))
    words, starts = split_words(lowered)
    per_text = np.diff(starts)
    lengths = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    # The words joined by single blanks; a shingle is a slice from its first word to its last.
    blank = pa.scalar(" ", pa.large_string())
    spaced = pc.binary_join_element_wise(words, pa.scalar("", pa.large_string()), blank)
    joined = value_bytes(spaced)
    begin = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1] if len(lengths) else lengths
    shingles = np.where(per_text > 0, np.maximum(per_text - shingle + 1, 1), 0)
    text = np.repeat(np.arange(len(per_text)), shingles)
    offset = np.arange(len(text)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    first = starts[:-1][text] + offset
    last = first + np.minimum(shingle, per_text[text]) - 1
    digest = xxhash.xxh64_intdigest
    ends = (begin[last] + lengths[last]).tolist()
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(begin[first].tolist(), ends)), dtype=np.uint64, count=len(text)
    )
    counts = bit_counts(hashes, text, len(per_text))
    over_half = 2 * counts > shingles[:, None]
    return np.packbits(over_half, axis=1, bitorder="little").view("<u8").ravel()


def with_fingerprint(docs: DataFrame, id_column: str, text_column: str, shingle: int) -> DataFrame:
    """(doc_id, text_hash, fp) per row; ``fp`` is the fingerprint as a signed long."""

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            fp = fingerprints(piece.column("text"), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("text_hash"), pa.array(fp)], ["doc_id", "text_hash", "fp"]
            )

    text = F.col(text_column)
    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(
        F.col(id_column).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")
    ).mapInArrow(compute, f"doc_id {kind}, text_hash long, fp long")


def bit_planes(values: np.ndarray) -> np.ndarray:
    """64 rows, one per bit: the bit of every value, packed into words of 64 values."""
    padded = np.zeros(-(-len(values) // 64) * 64, dtype=np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(bits.T.copy(), axis=1, bitorder="little").view(np.uint64)


def lanes_within(planes: np.ndarray, flips: np.ndarray, lanes: np.ndarray, radius: int) -> np.ndarray:
    """Lanes with at most ``radius`` set bits in ``planes ^ flips``, among ``lanes`` (both packed).

    Counters are bit-sliced too: ``counter[k]`` holds bit k of every lane's distance so
    far, and ``over`` the lanes beyond the radius. Words without a live lane are dropped.
    """
    found = np.zeros_like(lanes)
    at = np.flatnonzero(lanes)
    alive = lanes[at]
    bits = radius.bit_length()
    counter = [np.zeros_like(alive) for _ in range(bits)]
    over = ~alive
    for first in range(0, 64, 8):
        for plane in range(first, first + 8):
            carry = planes[plane, at] ^ flips[plane]
            for k in range(bits):
                counter[k], carry = counter[k] ^ carry, counter[k] & carry
            over = over | carry
        # Lanes whose counter exceeds the radius: the highest differing bit decides.
        greater, equal = np.zeros_like(over), np.full_like(over, ALL)
        for k in reversed(range(bits)):
            if radius >> k & 1:
                equal = equal & counter[k]
            else:
                greater, equal = greater | equal & counter[k], equal & ~counter[k]
        over = over | greater
        live = np.flatnonzero(over != ALL)
        if not len(live):
            return found
        if len(live) < len(at):
            at, over, counter = at[live], over[live], [c[live] for c in counter]
    found[at] = ~over
    return found


def block_links(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct ``values``: at most one pair per value.

    Each value queries the values not yet reached, so a dense group costs one pair per
    member instead of all its pairs.
    """
    planes = bit_planes(values)
    unreached = np.zeros(planes.shape[1] * 64, dtype=np.uint8)
    unreached[: len(values)] = 1
    unreached = np.packbits(unreached, bitorder="little").view(np.uint64)
    single = np.uint64(1)
    links: list[tuple[int, int]] = []
    for seed in range(len(values)):
        if not unreached[seed >> 6] >> np.uint64(seed & 63) & single:
            continue
        unreached[seed >> 6] &= ~(single << np.uint64(seed & 63))
        frontier = [seed]
        while frontier:
            query = frontier.pop()
            value = values[query]
            flips = np.where((value >> np.arange(64, dtype=np.uint64)) & single, ALL, np.uint64(0))
            found = lanes_within(planes, flips, unreached, radius)
            unreached &= ~found
            reached = np.flatnonzero(np.unpackbits(found.view(np.uint8), bitorder="little"))
            links.extend((query, int(r)) for r in reached)
            frontier.extend(reached.tolist())
    return links


def small_block_links(values: np.ndarray, block: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs within ``radius`` in blocks of at most ``SMALL`` values, as indexes; ``block`` is ascending."""
    left, right = [], []
    for step in range(1, SMALL):
        first = np.flatnonzero(block[:-step] == block[step:])
        if not len(first):
            break
        planes = bit_planes(values[first] ^ values[first + step])
        lanes = np.zeros(planes.shape[1] * 64, dtype=np.uint8)
        lanes[: len(first)] = 1
        found = lanes_within(planes, np.zeros(64, dtype=np.uint64), np.packbits(lanes, bitorder="little").view(np.uint64), radius)
        near = first[np.flatnonzero(np.unpackbits(found.view(np.uint8), bitorder="little"))]
        left.append(near)
        right.append(near + step)
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, int), np.zeros(0, int))


def bands_to_agree(radius: int, fingerprints: int) -> int:
    """How many of radius + t bands a block's fingerprints share: 2, more only if blocks would be large."""
    wanted = np.log2(max(fingerprints / BLOCK, 1))
    for agree in range(2, MOST_BANDS):
        if 64 * agree / (radius + agree) >= wanted:
            return agree
    return MOST_BANDS


def band_keys(fp: Column, radius: int, agree: int) -> Column:
    """One (choice, key) per choice of bands; fingerprints within ``radius`` share one at least."""
    bands = radius + agree
    cuts = [64 * b // bands for b in range(bands + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(bands), agree)):
        key = F.lit(0).cast("long")
        for b in chosen:
            width = cuts[b + 1] - cuts[b]
            part = F.shiftrightunsigned(fp, cuts[b]).bitwiseAND(F.lit((1 << width) - 1))
            key = F.shiftleft(key, width).bitwiseOR(part)
        keys.append(F.struct(F.lit(number).alias("choice"), key.alias("key")))
    return F.array(*keys)


def fingerprint_links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """(a, b) links among the distinct longs in column ``fp`` that connect whatever is within ``radius``."""
    agree = bands_to_agree(radius, fps.count())
    keyed = fps.select("fp", F.inline(band_keys(F.col("fp"), radius, agree)))
    # Blocks of one are dropped; blocks beyond CHUNK become pairs of chunks, every pair of rows meeting in one.
    sizes = keyed.groupBy("choice", "key").agg(F.count("*").alias("rows")).where("rows > 1")
    chunks = F.ceil(F.col("rows") / CHUNK).cast("int")
    mine = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    blocks = (
        keyed.join(sizes, ["choice", "key"])
        .withColumn("chunks", chunks)
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.expr("if(chunks = 1, array(0), sequence(0, chunks - 1))")))
        .select("choice", "key", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), "fp")
    )

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for values, starts in sorted_blocks(batches):
            sizes = np.diff(starts)
            block = np.repeat(np.arange(len(sizes)), sizes)
            small = np.flatnonzero((sizes <= SMALL)[block])
            a, b = small_block_links(values[small], block[small], radius)
            left, right = [small[a]], [small[b]]
            for large in np.flatnonzero(sizes > SMALL):
                links = np.array(block_links(values[starts[large] : starts[large + 1]], radius)).reshape(-1, 2)
                left.append(starts[large] + links[:, 0].astype(int))
                right.append(starts[large] + links[:, 1].astype(int))
            found = values.view(np.int64)
            columns = [pa.array(found[np.concatenate(side)]) for side in (left, right)]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    block = ["choice", "key", "x", "y"]
    dealt = blocks.repartition(*block).sortWithinPartitions(*block, "fp")
    return dealt.mapInArrow(compare, "a long, b long").distinct()


def sorted_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Values of whole blocks, one after the other, and where each starts (and the last ends).

    A block is a run of rows that agree in all columns but the last; one that goes on in
    the next batch is held back.
    """
    keys, fps = np.zeros((0, 4), dtype=np.int64), np.zeros(0, dtype=np.uint64)
    for batch in batches:
        new = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(4)], axis=1)
        keys = np.concatenate([keys, new])
        fps = np.concatenate([fps, batch.column(4).to_numpy().view(np.uint64)])
        starts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1]) if len(keys) else [0]
        if starts[-1]:
            yield fps[: starts[-1]], np.asarray(starts)
            keys, fps = keys[starts[-1] :], fps[starts[-1] :]
    if len(fps):
        yield fps, np.array([0, len(fps)])


def simhash_components(
    docs: DataFrame, radius: int = 2, shingle: int = 3, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, fingerprint (16 hex digits), component_id.

    Texts are lower-cased in A-Z, split at ASCII white space and shingled; a text with
    fewer words than a shingle is one shingle, one without words (or null) has the
    fingerprint 0 and links like any other. Rows whose fingerprints differ in at most
    ``radius`` bits are linked, and ``component_id`` is the smallest id reachable. A null
    id takes part; it is the component's id only if the component has no other.
    Repeated rows come back as often as they are there; an empty table gives no rows.
    Columns other than the two named are ignored.
    """
    rows = cut_lineage(with_fingerprint(docs, id_column, text_column, shingle), "fingerprints")
    fps = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    links = fingerprint_links(fps, radius)
    member = connected_components(links)
    linked = fps.join(member, fps.fp == member.node, "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component")
    )
    linked = cut_lineage(linked, "linked")
    # A table of its own, so that the rows of a large component can be split in the join.
    smallest = cut_lineage(linked.groupBy("component").agg(F.min("first_id").alias("component_id")), "smallest")
    named = linked.join(smallest, "component").select("fp", "component", "component_id")
    return rows.join(named, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "text_hash",
        "component",
    )


def drop_near_duplicates(docs: DataFrame, radius: int = 2, shingle: int = 3) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id (nulls last), then text hash.

    Components are those of `simhash_components`. Of rows that repeat an id and a text, one
    stays. Columns are those of ``docs``.
    """
    found = cut_lineage(simhash_components(docs, radius, shingle), "components")
    heads = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    rows = heads.groupBy("component", "doc_id", "text_hash").agg(F.count("*").alias("kept_rows"))
    first = rows.groupBy(F.col("component").alias("of")).agg(F.min("text_hash").alias("kept_hash"))
    kept = rows.join(first, (F.col("component") == F.col("of")) & (F.col("text_hash") == F.col("kept_hash")))
    key, mark = free_names(docs.columns, "kept_id", "kept_text")
    kept = cut_lineage(kept.select(F.col("doc_id").alias(key), F.col("kept_hash").alias(mark), "kept_rows"), "kept")
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (F.xxhash64("text") == F.col(mark))
    single = docs.join(kept.where("kept_rows = 1").drop("kept_rows"), same, "left_semi")
    # Rows that repeat id and text are rare: only they are compared.
    several = docs.join(kept.where("kept_rows > 1").drop("kept_rows"), same)
    return single.unionByName(several.dropDuplicates([key, mark]).drop(key, mark))
