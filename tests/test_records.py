"""The splittable multi-line CSV reader against Spark's own reader, which reads a file in one task."""

import csv
import io
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rosterline.sources import files
from rosterline.sources.records import MALFORMED

SMALL = "spark.sql.files.maxPartitionBytes"


@pytest.fixture()
def split(spark):
    """Blocks of a few bytes: every quoted newline lies near a border."""
    saved = {k: spark.conf.get(k) for k in (SMALL, "spark.sql.files.openCostInBytes")}

    def into(size):
        spark.conf.set(SMALL, str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield into
    for k, v in saved.items():
        spark.conf.set(k, v)


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", newline="") as f:
        f.write(text)
    return folder


def whole(spark, path):
    """Spark's reader: a file a task."""
    return sorted(map(str, (tuple(r) for r in spark.read.options(**files.CSV_OPTIONS).csv(path).collect())))


def ours(spark, path):
    return sorted(map(str, (tuple(r) for r in files.read_csv(spark, path, with_source=False).collect())))


fields = st.text(st.sampled_from('ab,"\n \r1'), max_size=7).map(lambda t: t.replace("\r", "\r\n").replace("\n ", "\n"))
tables = st.lists(st.tuples(fields, fields, fields), min_size=1, max_size=8)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=tables, size=st.integers(11, 60), quoting=st.sampled_from([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
def test_any_table_at_any_borders(spark, split, tmp_path_factory, rows, size, quoting):
    out = io.StringIO()
    writer = csv.writer(out, quoting=quoting, lineterminator="\n")
    writer.writerow(["a", "b", "c"])
    writer.writerows([["k", *r[1:]] for r in rows])
    folder = put(str(tmp_path_factory.mktemp("csv")), "t.csv", out.getvalue())
    expected = whole(spark, folder)
    split(size)
    assert ours(spark, folder) == expected
    assert len(expected) == len(rows)


@pytest.mark.parametrize("size", [13, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_odd_files(spark, split, tmp_path, size, end):
    lines = [
        "id,name,note", '1,"two', '', 'lines",x', "2,plain,y", '3,5" pipe,stray', '4,"say ""hi"",', 'and, more""",z',
        "", "5,short", "6,a,b,long", "id,name,note", '7,"",', '"8","q","last', 'one"', "9,end,no newline",
    ]
    folder = put(str(tmp_path / "a"), "t.csv", end.join(lines))
    put(folder, "u.csv", end.join(["ID,Name,NOTE", '10,"x', 'y",z', "11,b,c"]) + end)
    expected = whole(spark, folder)
    split(size)
    assert ours(spark, folder) == expected
    bad = files.read_csv(spark, folder, malformed=True).where(f"{MALFORMED} IS NOT NULL").collect()
    assert sorted(r[MALFORMED] for r in bad) == ["5,short", "6,a,b,long"]
    by_file = files.read_csv(spark, folder).groupBy("source_file").count().collect()
    assert sorted((os.path.basename(r.source_file), r["count"]) for r in by_file) == [("t.csv", 10), ("u.csv", 2)]


def test_one_file_is_read_by_many_tasks(spark, split, tmp_path):
    rows = [[i, f'line {i}\nand "more"' if i % 3 == 0 else f"plain {i}", i * 2] for i in range(3000)]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows([["a", "b", "c"], *rows])
    folder = put(str(tmp_path / "big"), "t.csv", out.getvalue())
    split(len(out.getvalue()) // 12)
    df = files.read_csv(spark, folder, with_source=False)
    assert sorted(tuple(r) for r in df.collect()) == sorted((str(a), b, str(c)) for a, b, c in rows)
    assert spark.read.option("lineSep", "\n").text(folder).rdd.getNumPartitions() >= 12
    assert spark.read.options(**files.CSV_OPTIONS).csv(folder).rdd.getNumPartitions() == 1


def test_headers_are_checked(spark, tmp_path):
    folder = put(str(tmp_path / "h"), "a.csv", "x,y\n1,2\n")
    put(folder, "b.csv", '"Y",x\n3,4\n')
    with pytest.raises(ValueError, match="header"):
        files.read_csv(spark, folder)
    quoted = put(str(tmp_path / "q"), "a.csv", "x,y\n1,2\n")
    put(quoted, "b.csv", '"X","Y"\n3,4\n')
    assert ours(spark, quoted) == ["('1', '2')", "('3', '4')"]


def test_empty_files(spark, tmp_path):
    folder = put(str(tmp_path / "e"), "a.csv", "x,y\n")
    assert files.read_csv(spark, folder).columns == ["x", "y", "source_file"] and ours(spark, folder) == []
    put(folder, "b.csv", "")
    assert ours(spark, folder) == []
