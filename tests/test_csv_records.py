"""Records put together from byte ranges against Spark's whole-file reader."""

import random
import re

import pytest
from pyspark.sql import functions as F

from pulsemart.sources import csv_records as records
from pulsemart.sources import scan_csv_tables
from pulsemart.sources.readers import scan_csv_table
from tests.test_sources import HEADERS, csv_folder

NAMES = ["a", "b", "c"]


@pytest.fixture
def small_ranges(spark):
    """Ranges of ``size`` bytes, whatever the file's size."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {key: spark.conf.get(key) for key in keys}

    def use(size):
        spark.conf.set(keys[0], str(size))
        spark.conf.set(keys[1], "0")

    yield use
    for key, value in before.items():
        spark.conf.set(key, value)


def whole_files(spark, path, names=NAMES):
    """What Spark reads with a task per file."""
    schema = ", ".join(f"{n} STRING" for n in [*names, "_corrupt"])
    read = spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True)
    return sorted(map(repr, map(tuple, read.option("columnNameOfCorruptRecord", "_corrupt").csv(path).collect())))


def in_ranges(spark, path, names=NAMES):
    df = records.parse_records(records.csv_records(spark, path, names), names, "_corrupt")
    return sorted(map(repr, map(tuple, df.select(*names, "_corrupt").collect())))


# Whether a quoted value is open after the line.
LINES = {
    "plain,text,1": False,
    'a,"b,c",d': False,
    '"open,b': True,
    'a,"': True,
    '"': True,
    '""': False,
    '"a""': True,
    '"a"" ,x"': False,
    'say "hi",b': False,
    '"a" ,b': False,
    '"a"b,"c': True,
    '"a" b"c,d': False,
    ' "a,b': False,
    "": False,
    '",': True,
    'x","y': True,
    '"a"\r': False,
}


@pytest.mark.parametrize("line", LINES)
def test_states_of_a_line(spark, line):
    outside = records.ends_inside(line, False)
    assert outside == LINES[line]
    if not re.search("[\r]", line):
        # Taken as the first line of a value that goes on, the reader says the same.
        assert records.ends_inside(line, True) == records.ends_inside('"' + line, False)
    regular = bool(re.match(records.REGULAR, line))
    assert not (regular and outside)
    java = spark.range(1).select(F.lit(line).rlike(records.REGULAR_JAVA)).first()[0]
    assert java == regular


def random_file(some, rows):
    values = ["x", "", "1.5", '"a, b"', '"two\nlines"', '"say ""hi"""', '"\n\n"', '"end""\n"', 'in "the" middle', '"late"r', ' "spaced"', '"tail" ', "é", '"a\r\nb"']
    text = "a,b,c\n"
    for _ in range(rows):
        width = some.choice([3] * 12 + [2, 4])
        text += ",".join(some.choice(values) for _ in range(width)) + some.choice(["\n"] * 8 + ["\n\n"])
    return text


@pytest.mark.parametrize("seed", range(4))
def test_same_rows_as_whole_files(spark, tmp_path, small_ranges, seed):
    some = random.Random(seed)
    folder = tmp_path / "t.csv"
    folder.mkdir()
    for i in range(3):
        (folder / f"part-{i}.csv").write_bytes(random_file(some, some.choice([0, 1, 60])).encode())
    want = whole_files(spark, str(folder))
    for size in (17, 64, 10**6):
        small_ranges(size)
        assert in_ranges(spark, str(folder)) == want, size


def test_windows_line_ends(spark, tmp_path, small_ranges):
    path = tmp_path / "t.csv"
    path.write_bytes(b'a,b,c\r\n1,"x\r\ny",2\r\n\r\n3,4,"z"\r\n5,6,\r\n')
    small_ranges(12)
    assert in_ranges(spark, str(path)) == whole_files(spark, str(path))


def test_long_values_over_many_ranges(spark, tmp_path, small_ranges):
    path = tmp_path / "t.csv"
    long = "\n".join(f"line {i}, with a comma" for i in range(400))
    path.write_text(f'a,b,c\n1,"{long}",2\n3,4,5\n"{long}","{long}",6\n7,8,9\n')
    want = whole_files(spark, str(path))
    for size in (100, 1000, 5000):
        small_ranges(size)
        assert in_ranges(spark, str(path)) == want


def test_a_value_that_is_never_closed(spark, tmp_path, small_ranges):
    path = tmp_path / "t.csv"
    path.write_text('a,b,c\n1,2,3\n4,"open\nx,y,z\n5,6,7')
    small_ranges(8)
    rows = records.parse_records(records.csv_records(spark, str(path), NAMES), NAMES, "_corrupt").orderBy("block", "number").collect()
    assert [r.a for r in rows] == ["1", "4"] and rows[1].b.endswith("open\nx,y,z\n5,6,7")


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_ranges):
    line = "t{0},\"Acme\nNo {0}\",starter,EMEA,Tech,1-50,Sam\n"
    folder = csv_folder(tmp_path, tenants=HEADERS["tenants"] + "".join(line.format(i) for i in range(20_000)))
    small_ranges(1 << 16)
    tenants = scan_csv_tables(spark, folder)["tenants"]
    sizes = tenants.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 8 and max(r["count"] for r in sizes) < 4000
    found = tenants.orderBy("ingest_seq").select("tenant_id", "company_name").collect()
    assert [tuple(r) for r in found] == [(f"t{i}", f"Acme\nNo {i}") for i in range(20_000)]


def test_the_first_scan_chooses_the_reader(spark, tmp_path):
    line = "t1,{},starter,EMEA,Tech,1-50,Sam\n"
    folder = csv_folder(tmp_path, tenants=HEADERS["tenants"] + line.format('"say ""hi"", twice"') + line.format('5" pipe'))
    path = f"{folder}/tenants.csv"
    assert not records.has_line_breaks(spark, path)
    plan = scan_csv_table(spark, "tenants", path)._jdf.queryExecution().executedPlan().toString()
    assert "Scan csv" in plan and "MapInArrow" not in plan
    with open(path, "a") as f:
        f.write(line.format('"two\nlines"'))
    assert records.has_line_breaks(spark, path)
    plan = scan_csv_table(spark, "tenants", path)._jdf.queryExecution().executedPlan().toString()
    assert "Scan text" in plan and "MapInArrow" in plan
    assert scan_csv_table(spark, "tenants", path).count() == 3


def test_long_lines_do_not_overflow_the_matcher(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b,c\n"' + 'x""' * 200_000 + '",' + "y" * 100_000 + ",1\n" + ",".join(['"v"'] * 50_000) + "\n")
    assert not records.has_line_breaks(spark, str(path))


def test_headers_must_agree(spark, tmp_path):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    (folder / "part-0.csv").write_text('a,b,c\n1,"x\ny",2\n')
    (folder / "part-1.csv").write_text("a,c,b\n1,2,3\n")
    with pytest.raises(Exception, match="has the columns"):
        in_ranges(spark, str(folder))


def test_other_ranges_than_before_are_noticed(spark, tmp_path, small_ranges):
    path = tmp_path / "t.csv"
    path.write_text("a,b,c\n" + '1,"x\ny",2\n' * 200)
    small_ranges(100)
    found = records.csv_records(spark, str(path), NAMES)
    small_ranges(150)
    lines = records.csv_lines(spark, str(path))
    again = records._records(lines, records.Ranges(frozenset(), 100, True), NAMES, True, False)
    with pytest.raises(Exception, match="other ranges"):
        again.count()
    small_ranges(100)
    assert found.count() == 200
