"""CSV records with line breaks in quoted values, read in byte ranges.

Spark's line reader gives every task the lines of its ranges. Whether a line break ends a record
depends on the quotes before it, so each range first tells in which state it ends, outside or
inside a quoted value, for either state it may begin in. Running over the ranges of a file in
order, these fix the state each range begins in, and tasks put their lines together to records.
Only the pieces of records that cross a border are brought together; everything else stays in
its task.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

QUOTED = r'"[^"]*(?:""[^"]*)*"[ \t]*'
# A line of whole values, a quote opening none of them but where it begins one.
REGULAR = rf'^(?:(?:{QUOTED}|[^",][^,]*|),)*(?:{QUOTED}|[^",][^,]*|)\r?$'
# The same without going back, for Java's matcher: values do not depend on what follows them.
REGULAR_JAVA = r'^(?:(?:"[^"]*+(?:""[^"]*+)*+"[ \t]*+|[^",][^,]*+)?+,)*+(?:"[^"]*+(?:""[^"]*+)*+"[ \t]*+|[^",\r][^,\r]*+)?+\r?$'
INSIDE = re.compile(r'[^"]*+(?:""[^"]*+)*+')
BLANKS = re.compile(r"[ \t]*+")

WHOLE, OPEN, FURTHER = 0, 1, 2


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted value is open at the end of a line.

    A quote opens a value only where the value begins; a doubled one stands for itself; after a
    closing quote with more than blanks behind it, the value goes on to the next comma or line.
    """
    line = line.removesuffix("\r")
    at = 0
    while True:
        if not inside and line[at : at + 1] != '"':
            comma = line.find(",", at)
            if comma < 0:
                return False
            at = comma + 1
            continue
        close = INSIDE.match(line, at if inside else at + 1).end()
        if close == len(line):
            return True
        behind = BLANKS.match(line, close + 1).end()
        inside = False
        comma = line.find(",", behind)
        if comma < 0:
            return False
        at = comma + 1


def csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, block, size): lines with the range of the file they are read from."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_block_length").alias("size"),
    )


def has_line_breaks(spark: SparkSession, path: str) -> bool:
    """Whether any line may leave a quoted value open; without one, lines are records."""
    lines = csv_lines(spark, path).select("value")
    return not lines.where(F.col("value").contains('"') & ~F.col("value").rlike(REGULAR_JAVA)).isEmpty()


@dataclass
class _Lines:
    """Lines of one range in a batch, and where a state can change."""

    lines: pa.Array

    def __post_init__(self):
        quoted = pc.match_substring(self.lines, '"')
        regular = pc.match_substring_regex(self.lines, REGULAR)
        self.quoted = pc.indices_nonzero(quoted).to_pylist()
        self.irregular = pc.indices_nonzero(pc.and_not(quoted, regular)).to_pylist()

    def __len__(self):
        return len(self.lines)

    def __getitem__(self, i: int) -> str:
        return self.lines[i].as_py()


def _next(places: list[int], k: int, at: int) -> int:
    while k < len(places) and places[k] < at:
        k += 1
    return k


def _end(lines: _Lines, inside: bool) -> bool:
    """The state after all lines; outside, regular lines change nothing, inside those without a quote."""
    at = q = r = 0
    while True:
        places = lines.quoted if inside else lines.irregular
        k = q = _next(places, q, at) if inside else q
        if not inside:
            k = r = _next(places, r, at)
        if k == len(places):
            return inside
        at = places[k]
        inside = ends_inside(lines[at], inside)
        at += 1


def _ranges(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int, int], pa.Array]]:
    """The lines of a batch by the range they come from, in their order."""
    file, block, size = (batch.column(c) for c in ("file", "block", "size"))
    first = 0
    while first < batch.num_rows:
        key = (file[first].as_py(), block[first].as_py(), size[first].as_py())
        # A batch seldom holds more than one range.
        same = pc.and_(pc.equal(file, file[first]), pc.equal(block, block[first]))
        after = pc.index(same.slice(first), False).as_py()
        stop = batch.num_rows if after < 0 else first + after
        yield key, pc.fill_null(batch.column("value").slice(first, stop - first), "")
        first = stop


def range_states(lines: DataFrame) -> DataFrame:
    """(file, block, size, from_outside, from_inside): per range, whether it ends inside a quoted value."""

    def states(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, key = [False, True], None

        def row():
            values = [[key[0]], [key[1]], [key[2]], [now[0]], [now[1]]]
            return pa.RecordBatch.from_arrays([pa.array(v) for v in values], ["file", "block", "size", "from_outside", "from_inside"])

        for batch in batches:
            for own, values in _ranges(batch):
                if own != key:
                    if key is not None:
                        yield row()
                    now, key = [False, True], own
                known = _Lines(values)
                # The two soon agree, then one of them is enough.
                outside = _end(known, now[0])
                now = [outside, outside if now[0] == now[1] else _end(known, now[1])]
        if key is not None:
            yield row()

    return lines.mapInArrow(states, "file string, block long, size long, from_outside boolean, from_inside boolean")


def begin_states(states: DataFrame) -> DataFrame:
    """``states`` with ``inside``: the state each range begins in, from all ranges before it.

    A range either fixes the state or leaves it or turns it round. The window runs over the
    ranges of a file, never its rows.
    """
    order = W.partitionBy("file").orderBy("block")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    turns = F.sum((F.col("from_outside") & ~F.col("from_inside")).cast("int"))
    fixed = F.when(F.col("from_outside") == F.col("from_inside"), F.struct(F.col("from_outside").alias("state"), F.col("turned")))
    counted = states.withColumn("turned", turns.over(order.rowsBetween(W.unboundedPreceding, 0)))
    last = counted.withColumn("last", F.last(fixed, ignorenulls=True).over(before)).withColumn(
        "turned_before", F.coalesce(F.max("turned").over(before), F.lit(0))
    )
    turned = (F.col("turned_before") - F.coalesce(F.col("last.turned"), F.lit(0))) % 2 == 1
    return last.withColumn("inside", F.coalesce(F.col("last.state"), F.lit(False)) != turned)


@dataclass(frozen=True)
class Ranges:
    """What tasks must know of a folder: ranges that begin inside a quoted value, the range's
    size, whether any record crosses a border. The first is as long as such ranges are many,
    which Spark's own list of ranges exceeds."""

    inside: frozenset[tuple[str, int]]
    size: int
    crossing: bool


def known_ranges(lines: DataFrame) -> Ranges:
    begun = begin_states(range_states(lines)).select(
        "file", "block", "size", "inside", F.when(F.col("inside"), F.col("from_inside")).otherwise(F.col("from_outside")).alias("open")
    )
    begun = begun.persist()
    try:
        size, crossing = begun.agg(F.max("size"), F.coalesce(F.max("open"), F.lit(False))).first()
        inside = frozenset((r.file, r.block) for r in begun.where("inside").select("file", "block").collect())
    finally:
        begun.unpersist()
    return Ranges(inside, size or 0, bool(crossing))


class _Records:
    """Puts the lines of one range after the other together to records."""

    def __init__(self, ranges: Ranges, names: list[str], whole: bool, pieces: bool):
        self.ranges, self.names = ranges, names
        self.wanted = {k for k, on in ((WHOLE, whole), (OPEN, pieces), (FURTHER, pieces)) if on}
        self.key: tuple[str, int, int] | None = None

    def begin(self, key: tuple[str, int, int]) -> None:
        file, block, size = key
        if size > self.ranges.size or self.ranges.size and block % self.ranges.size:
            raise RuntimeError(
                f"{file} is now read in other ranges than before; with a changing number of executors "
                "set spark.sql.files.minPartitionNum, or load the files with a target"
            )
        self.key, self.number = key, 0
        self.inside = (file, block) in self.ranges.inside
        self.held: list[str] = []
        self.kind = FURTHER if self.inside else WHOLE
        self.header = block == 0

    def _out(self, records: pa.Array, kind: int) -> Iterator[pa.RecordBatch]:
        records = records.cast(pa.large_string())
        if kind == WHOLE:
            if pc.any(pc.ends_with(records, "\r")).as_py():
                records = pc.replace_substring_regex(records, r"\r$", "")
            records = records.filter(pc.not_equal(records, ""))
        if not len(records):
            return
        numbers = pa.array(range(self.number, self.number + len(records)), pa.int64())
        self.number += len(records)
        heads = [False] * len(records)
        if self.header and kind != FURTHER:
            self.header = False
            heads[0] = True
            if kind == WHOLE:
                self._check(records[0].as_py())
        if kind in self.wanted:
            n = len(records)
            columns = [pa.array([self.key[0]] * n), pa.array([self.key[1]] * n, pa.int64()), numbers, pa.array([kind] * n, pa.int32()), pa.array(heads), records.cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["file", "block", "number", "kind", "header", "record"])

    def _check(self, record: str) -> None:
        found = next(csv.reader([record]), [])
        if [n.removeprefix("﻿") for n in found] != self.names:
            raise ValueError(f"{self.key[0]} has the columns {found}, not {self.names}")

    def take(self, values: pa.Array) -> Iterator[pa.RecordBatch]:
        lines = _Lines(values)
        at = q = r = 0
        while at < len(lines):
            if not self.inside:
                r = _next(lines.irregular, r, at)
                stop = lines.irregular[r] if r < len(lines.irregular) else len(lines)
                if stop > at:
                    yield from self._out(values.slice(at, stop - at), WHOLE)
                if stop == len(lines):
                    return
                self.inside = ends_inside(lines[stop], False)
                if self.inside:
                    self.held, self.kind = [lines[stop]], OPEN
                else:
                    yield from self._out(values.slice(stop, 1), WHOLE)
                at = stop + 1
                continue
            q = _next(lines.quoted, q, at)
            stop = lines.quoted[q] if q < len(lines.quoted) else len(lines)
            self.held += values.slice(at, stop - at).to_pylist()
            if stop == len(lines):
                return
            self.held.append(lines[stop])
            self.inside = ends_inside(lines[stop], True)
            at = stop + 1
            if not self.inside:
                kind = WHOLE if self.kind == OPEN else FURTHER
                record = "\n".join(self.held)
                if kind == WHOLE and record.endswith("\r"):
                    record = record.replace("\r\n", "\n")
                yield from self._out(pa.array([record]), kind)
                self.held, self.kind = [], WHOLE

    def finish(self) -> Iterator[pa.RecordBatch]:
        if self.key is not None and self.inside and self.held:
            yield from self._out(pa.array(["\n".join(self.held)]), self.kind)


def _records(lines: DataFrame, ranges: Ranges, names: list[str], whole: bool, pieces: bool) -> DataFrame:
    def assemble(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Records(ranges, names, whole, pieces)
        for batch in batches:
            for key, values in _ranges(batch):
                if key != own.key:
                    yield from own.finish()
                    own.begin(key)
                yield from own.take(values)
        yield from own.finish()

    return lines.mapInArrow(assemble, "file string, block long, number long, kind int, header boolean, record string")


def csv_records(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """(file, block, number, record): the text of every record but the headers, in the order of the three.

    Empty lines between records are left out. The files must have the header ``names``. In a
    record that ends with carriage return and line feed, both together are one line break
    everywhere. A value that is never closed takes the rest of its file. A record belongs to the
    range it begins in.
    """
    lines = csv_lines(spark, path)
    ranges = known_ranges(lines)
    columns = ["file", "block", "number", "record"]
    found = _records(lines, ranges, names, whole=True, pieces=False).where(~F.col("header")).select(*columns)
    if not ranges.crossing:
        return found
    parts = _records(lines, ranges, names, whole=False, pieces=True)
    # At most two pieces a range.
    order = W.partitionBy("file").orderBy("block", "number")
    begun = parts.withColumn("opened", F.sum((F.col("kind") == OPEN).cast("int")).over(order))
    joined = begun.groupBy("file", "opened").agg(
        F.min(F.struct("block", "number")).alias("first"),
        F.max("header").alias("header"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "number", "record"))), lambda p: p["record"]), "\n").alias("record"),
    )
    text = F.col("record")
    text = F.when(text.endswith("\r"), F.regexp_replace(F.regexp_replace(text, "\r\n", "\n"), "\r$", "")).otherwise(text)
    crossing = joined.where(~F.col("header")).select("file", "first.block", "first.number", text.alias("record"))
    return found.unionByName(crossing)


def parse_records(records: DataFrame, names: list[str], corrupt: str, parse: Callable = F.from_csv) -> DataFrame:
    """``records`` with a text column for each name, and ``corrupt`` where a record has not their number."""
    schema = ", ".join(f"`{n.replace('`', '``')}` STRING" for n in [*names, corrupt])
    options = {"escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": corrupt, "mode": "PERMISSIVE"}
    return records.withColumn("parsed", parse("record", schema, options)).select("file", "block", "number", "parsed.*")
