"""Files with quoted line breaks: many ranges give what one task gives."""

import csv
import io
import random

import pytest

from tallyloom.sources.delimited import ORIGIN_COLUMN, read_delimited_text
from tallyloom.sources.quoted_ranges import _lines, range_states


@pytest.fixture
def small_ranges(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000b")
    spark.conf.set("spark.sql.files.openCostInBytes", "100b")
    yield spark
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def written(path, rows, encoding="latin-1", end="\n", sep=";"):
    text = io.StringIO(newline="")
    csv.writer(text, delimiter=sep, lineterminator=end).writerows(rows)
    path.write_bytes(text.getvalue().encode(encoding))


def rows_like(rng, n):
    bits = ["a", "é", '"', ";", "\n", "\r\n", " ", "x" * 40, "", "NA"]
    return [[str(i), "".join(rng.choice(bits) for _ in range(rng.randrange(9))), rng.choice(["", "y", "q\n" * 30])] for i in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_many_ranges_equal_the_written_rows(small_ranges, tmp_path, end):
    spark, rng = small_ranges, random.Random(3)
    parts = {f"f{k}.csv": rows_like(rng, 150) for k in range(3)}
    for name, rows in parts.items():
        written(tmp_path / name, [[" id", "text ", "note"], *rows], end=end)
    assert range_states(_lines(spark, str(tmp_path))).where("inside").count() > 3
    df = read_delimited_text(spark, str(tmp_path))
    assert df.rdd.getNumPartitions() > 20
    got = sorted((r.id, r.text, r.note, r[ORIGIN_COLUMN]) for r in df.collect())
    assert got == sorted((*row, name) for name, rows in parts.items() for row in rows)


def test_a_value_longer_than_several_ranges(small_ranges, tmp_path):
    long = 'line of a long "note"\n' * 400
    rows = [["1", long], ["2", "z"], ["3", long + "end"]]
    written(tmp_path / "a.csv", [["id", "text"], *rows], "utf-8")
    got = read_delimited_text(small_ranges, str(tmp_path / "a.csv"), encoding="utf-8", origin=False).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, rows))


def test_same_as_one_task_without_breaks_and_with_blank_lines(small_ranges, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'a;b\n1;x\n\n2;"y;z"\n\n3;\n')
    read = lambda **k: sorted(map(tuple, read_delimited_text(small_ranges, str(tmp_path), **k).collect()))
    assert read() == read(by_ranges=False) == [("1", "x", "a.csv"), ("2", "y;z", "a.csv"), ("3", "", "a.csv")]


@pytest.mark.parametrize("text, match", [
    ('a;b\n1;x\n2;5" pipe\n3;7" tube\n', "quotes inside a value"), ('a;b\n1;"x\n2;y\n', "not closed"), ("a;b\n1;x;3\n", "(?s)."), ("a;b\n1\n", "(?s)."), ("a;b\n1;2\n \n", "(?s)."),
])
def test_malformed_files_fail(small_ranges, tmp_path, text, match):
    (tmp_path / "a.csv").write_text(text)
    with pytest.raises(Exception, match=match):
        read_delimited_text(small_ranges, str(tmp_path)).collect()


def test_another_header_fails(small_ranges, tmp_path):
    (tmp_path / "a.csv").write_text("a;b\n1;2\n")
    (tmp_path / "b.csv").write_text("a;c\n1;2\n")
    with pytest.raises(Exception, match="another header"):
        read_delimited_text(small_ranges, str(tmp_path)).collect()


def test_encodings_that_hide_quotes_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a;b\n1;2\n", encoding="utf-16")
    with pytest.raises(ValueError, match="single bytes"):
        read_delimited_text(spark, str(tmp_path), encoding="utf-16")


def test_ranges_that_were_not_counted_fail(small_ranges, tmp_path):
    written(tmp_path / "a.csv", [["id", "text"], *([str(i), "x\ny"] for i in range(500))])
    df = read_delimited_text(small_ranges, str(tmp_path))
    small_ranges.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    small_ranges.conf.set("spark.sql.files.openCostInBytes", "70b")
    with pytest.raises(Exception, match="have changed"):
        df.select("id").collect()
