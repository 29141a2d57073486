"""WARC archives: one gzip member per record, written by tasks and read back by byte range.

Writing: every task writes files of its own and reports them in a manifest, which Spark
stores as a table. Only files in the manifest belong to the archive, so what a lost or
repeated task has left behind is never read. Reading: a task gets a byte range, scans it
for gzip magic, takes a candidate for a member only if its decoded beginning is a WARC
header, and owns the records that start inside its range, to their end beyond it.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemart.session import cut_lineage, new_table_path

# A payload is stored once if it has so many bytes.
SMALLEST_REVISIT = 100
FILE_BYTES = 1 << 28
RANGE_BYTES = 16 << 20
MOST_TASKS = 50_000
READ_BYTES = 1 << 18
BATCH_BYTES = 4 << 20
LEVEL = 4
MAGIC = b"\x1f\x8b\x08"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:x-page:"


def page_records(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, digest, first_id): ``first_id`` is set on rows that revisit another's payload."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    records = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    large = F.octet_length("payload") >= SMALLEST_REVISIT
    # Only digests that occur more than once; the payloads are not shuffled to find them.
    repeated = (
        records.where(large)
        .groupBy(F.col("digest").alias("same"))
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1")
        .select("same", "first_id")
    )
    repeated = cut_lineage(repeated, "repeated-payloads")
    joined = records.join(repeated, (F.col("digest") == F.col("same")) & large, "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select("page_id", "url", "payload", "digest", F.when(revisit, F.col("first_id")).alias("first_id"))


def header_value(text: str) -> str:
    """Line breaks and other controls cannot stand in a header: they are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def record_bytes(page_id, url: str | None, payload: bytes, digest: str, first_id) -> bytes:
    """One record, compressed as a gzip member of its own. A revisit has the HTTP header without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first_id is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first_id is None else 'revisit'}",
        f"WARC-Record-ID: <{ID}{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {header_value(url)}")
    if first_id is not None:
        lines += [f"WARC-Refers-To: <{ID}{first_id}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode()) + packer.compress(block + b"\r\n\r\n") + packer.flush()


def open_folder(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path)


def write_warc(records: DataFrame, folder: str) -> DataFrame:
    """Write `page_records` to files in ``folder``; returns the stored manifest (file, bytes, records)."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = open_folder(folder)
        system.create_dir(base, recursive=True)
        name, out, size, count, done = "", None, 0, 0, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "first_id"))):
                if out is None:
                    name, size, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                member = record_bytes(*row)
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= FILE_BYTES:
                    out.close()
                    out = None
                    done.append((name, size, count))
        if out is not None:
            out.close()
            done.append((name, size, count))
        if done:
            names, sizes, counts = zip(*done)
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{folder}/{n}" for n in names]), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                ["file", "bytes", "records"],
            )

    return cut_lineage(records.mapInArrow(write, "file string, bytes long, records long"), "warc-manifest")


def decode_header(data: bytes) -> dict[str, str]:
    """Header lines by lower-case name, with the first line under ""."""
    first, *lines = data.decode("utf-8", "replace").split("\r\n")
    return {"": first} | {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


class RangeReader:
    """The records of one file that start in ``[start, end)``."""

    def __init__(self, stream, start: int, end: int, size: int):
        self.stream, self.end, self.size = stream, end, size
        self.position = start  # of the first byte in the buffer
        self.buffer = b""

    def fill(self, wanted: int) -> bool:
        """Have at least ``wanted`` bytes in the buffer, unless the file ends before."""
        while len(self.buffer) < wanted:
            self.stream.seek(self.position + len(self.buffer))
            more = self.stream.read(max(READ_BYTES, wanted - len(self.buffer)))
            if not more:
                return False
            self.buffer += more
        return True

    def drop(self, count: int) -> None:
        self.buffer = self.buffer[count:]
        self.position += count

    def is_record(self) -> bool:
        """Whether the buffer begins a gzip member that decodes to a WARC header."""
        self.fill(512)
        try:
            return zlib.decompressobj(31).decompress(self.buffer[:512], 7)[:7] == b"WARC/1."
        except zlib.error:
            return False

    def member(self) -> bytes:
        """Decode the member at the buffer's start and move behind it."""
        decoder, parts = zlib.decompressobj(31), []
        while not decoder.eof:
            if not self.buffer and not self.fill(1):
                raise ValueError(f"a record is cut off at byte {self.position}")
            parts.append(decoder.decompress(self.buffer))
            rest = decoder.unused_data if decoder.eof else b""
            self.drop(len(self.buffer) - len(rest))
        return b"".join(parts)

    def __iter__(self) -> Iterator[tuple[int, bytes]]:
        while self.position < self.end:
            if not self.fill(3):
                return
            at = self.buffer.find(MAGIC)
            if at < 0:
                self.drop(len(self.buffer) - 2)
            elif at:
                self.drop(at)
            elif self.is_record():
                offset = self.position
                yield offset, self.member()
            else:
                self.drop(1)


RECORD = (
    "file string, offset long, page_id string, record_type string, target_uri string, "
    "payload_bytes long, payload_digest string, refers_to string, payload binary"
)


def parse_record(data: bytes) -> tuple:
    """Columns of `read_warc` from page_id on; a stored payload must match its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    header = decode_header(head)
    block = rest[: int(header["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(decode_header(http)["content-length"])
    declared = header["warc-payload-digest"].removeprefix("sha256:")
    name = lambda key: header.get(key, "").removeprefix(f"<{ID}").removesuffix(">") or None
    revisit = header["warc-type"] == "revisit"
    if not revisit:
        found = hashlib.sha256(payload).hexdigest()
        if found != declared or len(payload) != length:
            raise ValueError(f"payload of {header['warc-record-id']} does not match its digest or length")
    return (
        name("warc-record-id"), header["warc-type"], header.get("warc-target-uri"), length, declared,
        name("warc-refers-to"), None if revisit else payload,
    )


def read_warc(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of all files in ``manifest`` (file, bytes), in columns `RECORD`.

    A revisit has no payload of its own (null), but its full length and digest. Files are
    split into ranges of ``RANGE_BYTES``, so neither a large file nor many small ones end
    in one task. Without ``with_payload`` payloads are checked and left out.
    """
    last = F.greatest(F.col("bytes") - 1, F.lit(0))
    starts = F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(RANGE_BYTES).cast("long")))
    ranges = manifest.where("bytes > 0").select("file", "bytes", starts.alias("start"))
    fields = [f.split() for f in RECORD.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[k]) for n, k in fields])

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, size, start in zip(*(batch.column(c).to_pylist() for c in ("file", "bytes", "start"))):
                system, path = open_folder(file)
                rows, held = [], 0
                with system.open_input_file(path) as stream:
                    for offset, data in RangeReader(stream, start, start + RANGE_BYTES, size):
                        row = (file, offset, *parse_record(data))
                        rows.append(row if with_payload else (*row[:-1], None))
                        held += len(data)
                        if held >= BATCH_BYTES or len(rows) >= 10_000:
                            yield to_batch(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield to_batch(rows, schema)

    # Ranges are a few bytes each, so a shuffle left to Spark would end in one task; a number that is
    # given is kept. One range a task, several where there would be more tasks than a driver plans well.
    count = ranges.count()
    return ranges.repartition(max(1, -(-count // max(1, -(-count // MOST_TASKS))))).mapInArrow(read, RECORD)


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def archive_pages(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html); returns the manifest.

    The payload is the html in UTF-8, empty for null. Of rows with equal payloads of at
    least ``SMALLEST_REVISIT`` bytes the one with the smallest page_id is a response and
    the others revisit it; rows that repeat that smallest id are all responses, and so are
    all if every id is null. An empty table gives an empty manifest. Other columns are
    ignored.
    """
    return write_warc(page_records(pages), folder or new_table_path(spark, "warc"))
