"""Hand-worked earthquake rows, through real CSV files."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from feedmill.operators import quakes
from feedmill.plans import quake_convert
from feedmill.schemas import QUAKE_COLUMNS
from feedmill.sources import read_avro, read_parquet, read_quake_csv

HEADER = "Longitude,UTC_Date,Profundity,Magnitude,Date,Hour,Unused,Location,Latitude"


def _csv(folder, *rows, name="quakes.csv"):
    path = folder / name
    path.write_text("\n".join([HEADER, *rows]) + "\n", encoding="utf-8")
    return str(path)


def _line(utc="2001-02-03T04:05:06", day="2001-02-03", hour="01:05:06", place="Arica", lat="-18.5", lon="-70.321"):
    return f"{lon},{utc},30 km,4.5 Ml,{day},{hour},x,{place},{lat}"


def test_both_projections(spark, tmp_path):
    path = _csv(
        tmp_path,
        _line(),
        "",
        _line(place='"12 km ""al N"",\nof Iquique, Ñuñoa"', hour="23:59:59.999", lat="1E1"),
        f"-70.1,2001-02-03 04:05:06.250,,,2001-02-03,00:00,x,,-18",
    )
    rows = read_quake_csv(spark, path)
    assert rows.columns == QUAKE_COLUMNS
    table = quakes.parquet_rows(rows).collect()
    assert len(table) == 3
    first = table[0].asDict()
    assert first == {
        "UTC_Date": dt.datetime(2001, 2, 3, 4, 5, 6), "Profundity": "30 km", "Magnitude": "4.5 Ml",
        "Date": dt.date(2001, 2, 3), "Hour": 3906000, "Location": "Arica",
        "Latitude": Decimal("-18.500"), "Longitude": Decimal("-70.321"),
    }
    assert table[1]["Location"] == '12 km "al N",\nof Iquique, Ñuñoa' and table[1]["Hour"] == 86399000
    assert table[1]["Latitude"] == Decimal("10.000")
    assert (table[2]["Profundity"], table[2]["Magnitude"], table[2]["Location"], table[2]["Hour"]) == ("", "", "", 0)
    assert table[2]["UTC_Date"].microsecond == 250000
    santiago = quakes.avro_rows(rows, zone="America/Santiago").collect()
    assert santiago[0]["UTC_Date"] == dt.datetime(2001, 2, 3, 7, 5, 6)


def test_decimals_round_half_even_in_avro_and_are_refused_in_parquet(spark, tmp_path):
    values = ["1.2345", "1.2355", "-1.2345", "1.23450000001", "1.2340", "99.9994"]
    rows = read_quake_csv(spark, _csv(tmp_path, *[_line(lat=v) for v in values]))
    got = [r["Latitude"] for r in quakes.avro_rows(rows).collect()]
    assert got == [Decimal(v) for v in ("1.234", "1.236", "-1.234", "1.235", "1.234", "99.999")]
    exact = read_quake_csv(spark, _csv(tmp_path, _line(lat="1.2340"), _line(lat="nan"), name="b.csv"))
    assert [r["Latitude"] for r in quakes.parquet_rows(exact).collect()] == [Decimal("1.234"), None]


BAD = [
    ("parquet", dict(lat="1.2345")), ("parquet", dict(lat="1.0000000000000000000000000001")), ("parquet", dict(lat="100")),
    ("parquet", dict(utc="2001-02-03T04:05:06.123456")), ("parquet", dict(utc="2001-2-3")), ("parquet", dict(lon="")),
    ("parquet", dict(hour="25:00")), ("parquet", dict(day="2001-02-30")), ("parquet", dict(hour="")),
    ("avro", dict(lat="100")), ("avro", dict(utc="")), ("avro", dict(lat="nan")), ("avro", dict(day="2001-02-03T00:00:00")),
    ("avro", dict(hour="1:05")), ("avro", dict(lon="abc")),
]


@pytest.mark.parametrize("kind,change", BAD)
def test_bad_values_stop_the_job(spark, tmp_path, kind, change):
    rows = read_quake_csv(spark, _csv(tmp_path, _line(), _line(**change)))
    project = quakes.avro_rows if kind == "avro" else quakes.parquet_rows
    with pytest.raises(PySparkException, match="cannot convert"):
        project(rows).collect()


def test_avro_drops_sub_milliseconds_toward_zero(spark, tmp_path):
    texts = ["1960-01-01T00:00:00.123999+00:00", "2024-01-01T00:00:00.123999+00:00"]
    rows = quakes.avro_rows(read_quake_csv(spark, _csv(tmp_path, *[_line(utc=t) for t in texts])))
    assert [r[0] for r in rows.selectExpr("unix_millis(UTC_Date)").collect()] == [-315619199876, 1704067200123]


def test_time_type(spark, tmp_path):
    spark.conf.set("spark.sql.timeType.enabled", "true")
    rows = read_quake_csv(spark, _csv(tmp_path, _line(hour="23:05:06.7")))
    (row,) = quakes.parquet_rows(rows, time_type=True).select("Hour").collect()
    assert row["Hour"] == dt.time(23, 5, 6)


def test_conversion_matrix(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    path = _csv(tmp_path, *[_line(hour=f"{h:02d}:00:00") for h in range(24)])
    outputs = quake_convert.convert_all(spark, [path], str(tmp_path / "out"))
    assert [o.path.split("/")[-1] for o in outputs] == [
        "quakes.csv.null.avro", "quakes.csv.deflate.avro", "quakes.csv.snappy.avro",
        "quakes.csv.NONE.parquet", "quakes.csv.SNAPPY.parquet", "quakes.csv.GZIP.parquet", "quakes.csv.LZ4.parquet",
    ]
    frames = [(read_avro if o.format == "avro" else read_parquet)(spark, o.path) for o in outputs]
    for frame in frames:
        assert frame.columns == QUAKE_COLUMNS and frame.count() == 24
    assert sorted(map(tuple, frames[0].collect())) == sorted(map(tuple, frames[1].collect()))
    assert dict(frames[0].dtypes)["Latitude"] == "decimal(5,3)" and dict(frames[0].dtypes)["Hour"] == "int"
    (part, *_) = [p for p in (tmp_path / "out" / "quakes.csv.deflate.avro").iterdir() if p.suffix == ".avro"]
    head = part.read_bytes()[:900]
    assert b"time-millis" in head and b"deflate" in head and b'"name":"Earthquake","namespace":"test"' in head
    # Nothing is overwritten unasked.
    with pytest.raises(PySparkException):
        quake_convert.convert(spark, path, str(tmp_path / "out"), "avro", "null")
