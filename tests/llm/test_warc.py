"""WARC: oracle, round trip, byte ranges of any size, foreign members, edge cases."""

import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from pulsemart.llm import oracle, queries, warc
from tests.compare import connect, duck_rows, spark_rows


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_equals_sql(spark, folder):
    assert spark_rows(queries.op6_warc(spark, folder)) == duck_rows(connect(folder), oracle.ORACLES["op6_warc"])


def odd_pages(spark):
    long, other = "Grüße " * 40, "x" * 200_000
    rows = [
        (1, "http://a/1", long), (2, "http://a/2", long), (3, None, long), (4, "http://a/\r\nb", "short"), (5, "u", "short"),
        (6, "u", None), (7, "u", ""), (8, "u", other), (1, "again", long), (None, "n", long), (9, "u", "\x1f\x8b\x08 WARC/1.1\r\n\r\n"),
    ]
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string"), rows


@pytest.mark.parametrize("size", [7, 100, 5000, 1 << 24])
def test_round_trip_in_any_ranges(spark, monkeypatch, size):
    monkeypatch.setattr(warc, "RANGE_BYTES", size)
    monkeypatch.setattr(warc, "READ_BYTES", 600)
    pages, rows = odd_pages(spark)
    pages = pages.where("page_id IS NULL OR page_id != 8") if size < 100 else pages
    rows = [r for r in rows if r[0] != 8 or size >= 100]
    got = warc.read_warc(warc.archive_pages(spark, pages.repartition(3))).collect()
    assert len(got) == len(rows)
    payload = {r.page_id: r.payload for r in got if r.record_type == "response"}
    for r in got:
        html = next((p[2] or "") for p in rows if str(p[0]) == str(r.page_id)).encode()
        assert r.payload_bytes == len(html) and r.payload_digest == hashlib.sha256(html).hexdigest()
        assert (payload[r.refers_to] if r.record_type == "revisit" else bytes(r.payload)) == html
    kinds = sorted((str(r.page_id), r.record_type) for r in got)
    assert [k for i, k in kinds if i == "1"] == ["response"] * 2
    assert all(k == "revisit" for i, k in kinds if i in ("2", "3", "None"))
    assert all(k == "response" for i, k in kinds if i in ("4", "5", "6", "7", "9"))
    assert {r.target_uri for r in got if r.page_id == "4"} == {"http://a/%0D%0Ab"}


def test_files_are_plain_warc(spark, tmp_path):
    pages, rows = odd_pages(spark)
    manifest = warc.archive_pages(spark, pages, f"file://{tmp_path}/w").collect()
    assert sum(m.records for m in manifest) == len(rows)
    text = b"".join(gzip.decompress(open(m.file.removeprefix("file://"), "rb").read()) for m in manifest)
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == len(rows)


def test_only_files_in_the_manifest_are_read(spark, tmp_path):
    pages, rows = odd_pages(spark)
    manifest = warc.archive_pages(spark, pages, f"file://{tmp_path}/w")
    (tmp_path / "w" / "left-behind.warc.gz").write_bytes(warc.record_bytes(77, "u", b"p", hashlib.sha256(b"p").hexdigest(), None))
    assert warc.read_warc(manifest, with_payload=False).count() == len(rows)


def test_other_members_and_damage(spark, tmp_path):
    record = warc.record_bytes(1, "u", b"hello", hashlib.sha256(b"hello").hexdigest(), None)
    noise = gzip.compress(b"not a record") + b"\x1f\x8b\x08 broken" + b"\x1f\x8b"
    (tmp_path / "a").write_bytes(noise + record + noise + record + b"\x1f\x8b")
    manifest = spark.createDataFrame([(f"file://{tmp_path}/a", (tmp_path / "a").stat().st_size)], "file string, bytes long")
    assert [bytes(r.payload) for r in warc.read_warc(manifest).collect()] == [b"hello", b"hello"]
    (tmp_path / "b").write_bytes(record[:-12])
    cut = spark.createDataFrame([(f"file://{tmp_path}/b", len(record) - 12)], "file string, bytes long")
    with pytest.raises(Exception, match="cut off"):
        warc.read_warc(cut).collect()


def test_no_pages(spark):
    pages, _ = odd_pages(spark)
    assert warc.read_warc(warc.archive_pages(spark, pages.limit(0))).count() == 0


def test_ranges_are_read_by_many_tasks(spark, tmp_path, monkeypatch):
    """As many tasks as ranges, though a range is a few bytes for a shuffle that merges small partitions."""
    monkeypatch.setattr(warc, "RANGE_BYTES", 4096)
    rows = [(i, f"u{i}", random.Random(i).randbytes(600).hex()) for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    manifest = warc.archive_pages(spark, pages, f"file://{tmp_path}/w")
    ranges = sum(-(-m.bytes // 4096) for m in manifest.collect())
    read = warc.read_warc(manifest, with_payload=False)
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"
    parts = read.select(F.spark_partition_id().alias("task"), "page_id").collect()
    assert len(parts) == 300 and ranges > 20
    assert len({r.task for r in parts}) > ranges / 2
    monkeypatch.setattr(warc, "MOST_TASKS", 5)
    assert warc.read_warc(manifest, with_payload=False).rdd.getNumPartitions() <= 5
    assert warc.read_warc(manifest, with_payload=False).count() == 300
