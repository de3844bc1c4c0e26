"""CSV with quoted line breaks in many ranges against Spark's own whole-file reading."""

import collections
import random

import pytest

from feedmill.schemas import QUAKE_COLUMNS
from feedmill.sources import read_quake_csv
from feedmill.sources.quoted_csv import csv_records, read_quoted_csv

SIZES = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")


@pytest.fixture
def ranges_of(spark):
    """Make scan tasks read so many bytes, for one test."""
    before = {k: spark.conf.get(k, None) for k in SIZES}

    def cut(size):
        for key, value in zip(SIZES, (f"{size}b", "0b", "1")):
            spark.conf.set(key, value)

    yield cut
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def bag(df):
    return collections.Counter(tuple(r) for r in df.collect())


def whole(spark, path):
    return spark.read.options(header=True, multiLine=True, escape='"').csv(str(path))


def random_file(pick, end, stray):
    def field():
        kind = pick.random()
        if kind < 0.35:
            return "".join(pick.choice("abé 1") for _ in range(pick.randint(0, 8)))
        if kind < 0.45 and stray:
            return pick.choice(['a"b', 'a""', '5" pipe', 'x"y"z'])
        inner = "".join(pick.choice(['""', ",", end, "\n", "é", "a", " ", ""]) for _ in range(pick.randint(0, 9)))
        return f'"{inner}"'

    rows = [[field() for _ in range(3)] for _ in range(pick.randint(5, 25))]
    last = pick.choice(["", end])
    return end.join(['a,"b ""x""",c', *(",".join(r) for r in rows if any(r))]) + last


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("stray", [False, True])
def test_ranges_of_any_size_give_the_rows_of_the_whole_file(spark, tmp_path, ranges_of, end, stray):
    pick = random.Random(len(end) * 2 + stray)
    for k in range(3):
        (tmp_path / f"{k}.csv").write_bytes(random_file(pick, end, stray).encode())
    want = bag(whole(spark, tmp_path))
    assert sum(want.values()) > 10
    for size in (12, 150):
        ranges_of(size)
        assert bag(read_quoted_csv(spark, str(tmp_path))) == want, size


def test_one_field_over_many_ranges(spark, tmp_path, ranges_of):
    long = "\n".join(f'line {i}, said ""{i}""' for i in range(120))
    (tmp_path / "a.csv").write_text(f'a,b\n1,"{long}"\n2,x\n3,"{long}\n"\n', encoding="utf-8")
    ranges_of(100)
    assert read_quoted_csv(spark, str(tmp_path)).rdd.getNumPartitions() > 30
    assert bag(read_quoted_csv(spark, str(tmp_path))) == bag(whole(spark, tmp_path))


def test_a_header_over_ranges_empty_files_and_a_quote_left_open(spark, tmp_path, ranges_of):
    header = '"a\nb",c\n'
    (tmp_path / "a.csv").write_text(header + "1,2\n\n\n3,4", encoding="utf-8")
    (tmp_path / "b.csv").write_text(header, encoding="utf-8")
    (tmp_path / "c.csv").write_text(header + '5,"open\nto the end\n', encoding="utf-8")
    ranges_of(3)
    rows = read_quoted_csv(spark, str(tmp_path))
    assert rows.columns == ["a\nb", "c"]
    assert {(r[0], (r[1] or "").strip()) for r in rows.collect()} == {("1", "2"), ("3", "4"), ("5", "open\nto the end")}


def test_records_keep_their_text(spark, tmp_path, ranges_of):
    (tmp_path / "a.csv").write_bytes(b'a,b\r\n1,"x\r\ny"\r\n2,z\r\n')
    ranges_of(4)
    records = {r.record: r.first for r in csv_records(spark, str(tmp_path)).collect()}
    assert records == {"a,b": True, '1,"x\ny"': False, "2,z": False}


def test_headers_that_differ_stop_the_job(spark, tmp_path, ranges_of):
    for name, columns in (("a.csv", QUAKE_COLUMNS), ("b.csv", QUAKE_COLUMNS[::-1])):
        (tmp_path / name).write_text(",".join(columns) + "\n" + ",".join("x" for _ in columns) + "\n")
    with pytest.raises(Exception, match="CSV header"):
        read_quake_csv(spark, str(tmp_path), split=True).collect()
