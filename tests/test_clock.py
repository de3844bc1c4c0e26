"""Clock text against the public parsers it follows."""

import datetime as dt
import itertools

import pytest
from dateutil import parser as iso_parser
from pyspark.sql import functions as F

from feedmill.functions import clock

DAYS = ["2025-07-04", "20250704", "2025-W27-5", "2025W275", "2025-W27", "2025W27", "2025-185", "2025185", "2025-07", "2025",
        "2025-02-30", "2025-13-01", "2025-7-4", "0000-01-01", "2024-366", "2025-366", "2020-W53-7", "2025-W54-1", "1969-12-31"]
CLOCKS = ["", "T04", "T04:03", "T0403", "T04:03:55", "T040355", " 04:03:55.123456", "T04:03:55,1234567", "x04:03:55.5",
          "T24:00", "T24:00:00", "T24:01", "T4:03", "T04:60", "T04:03:60", "T", "-04:03"]
OFFSETS = ["", "Z", "z", "+00:00", "+0530", "-03", "+23:59", "+24:00", "+05:60"]


def _texts():
    every = [d + c + o for d, c, o in itertools.product(DAYS, CLOCKS, OFFSETS)]
    return every + ["", " ", "not a time", "2025-07-04T04:03:55+00:00 ", "2025-07-04T04:03:55+1", "２０２５-07-04"]


def _column(spark, texts, make):
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, s string")
    return [r[1] for r in sorted(frame.select("n", make(F.col("s"))).collect())]


def _micros(moment):
    return (moment - dt.datetime(1970, 1, 1, tzinfo=moment.tzinfo and dt.timezone.utc)) // dt.timedelta(microseconds=1)


def _loose(text):
    try:
        moment = iso_parser.isoparse(text)
    except Exception:
        return None
    return _micros(moment if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc))


def test_iso_instant_matches_the_iso_parser(spark):
    texts = _texts()
    got = _column(spark, texts, lambda c: F.unix_micros(clock.iso_instant(c)))
    wrong = [(t, g, w) for t, g, w in zip(texts, got, map(_loose, texts)) if g != w]
    assert wrong == [], len(wrong)


def _strict(text):
    try:
        moment = dt.datetime.fromisoformat(text)
    except ValueError:
        return None
    return _micros(moment if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc))


def test_strict_instant_and_wall_clock_match_the_standard_library(spark):
    # Hour 24 and offsets past the hour are judged differently between library versions.
    texts = [t for t in _texts() if "24:00" not in t and "z" not in t and ":60" not in t]
    want = list(map(_strict, texts))
    got = _column(spark, texts, lambda c: F.unix_micros(clock.iso_instant(c, loose=False)))
    assert [(t, g, w) for t, g, w in zip(texts, got, want) if g != w] == []
    wall = _column(spark, texts, clock.iso_wall_clock)
    got = [None if w is None else _micros(w) for w in wall]
    assert [(t, g, w) for t, g, w in zip(texts, got, want) if g != w] == []


def test_bare_dates_and_clocks(spark):
    dates = _column(spark, DAYS, clock.iso_date)
    for text, got in zip(DAYS, dates):
        try:
            want = dt.date.fromisoformat(text)
        except ValueError:
            want = None
        assert got == want, text
    clocks = [c.lstrip("Tx ") for c in CLOCKS if "24" not in c] + ["T01:02:03", "01:02:03+05:00", "23:59:59.999999", "1:02"]
    for text, got in zip(clocks, _column(spark, clocks, clock.millis_of_day)):
        try:
            t = dt.time.fromisoformat(text)
            want = (t.hour * 3600 + t.minute * 60 + t.second) * 1000
        except ValueError:
            want = None
        assert got == want, text


STAMPS = ["2024-01-02 03:04:05", "2024-1-2 3:4:5", "2024-01-02   03:04:05", "2024-1- 2 3:4:5", "2024-01-02 03:04:60",
          "2024-02-30 00:00:00", "2024-01-02T03:04:05", " 2024-01-02 03:04:05", "2024-01-02 03:04:05 ", "24-01-02 03:04:05",
          "2024-13-01 00:00:00", "2024-01-02 24:00:00", "2024/01/02 03:04:05", "2024-01-02\t03:04:05", "2024-1-10 10:10:1", ""]


def test_stamp_matches_strptime(spark):
    for text, got in zip(STAMPS, _column(spark, STAMPS, lambda c: F.unix_seconds(clock.stamp_instant(c)))):
        try:
            want = int(dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S").replace(tzinfo=dt.timezone.utc).timestamp())
        except ValueError:
            want = None
        assert got == want, text


@pytest.mark.parametrize("session_zone", ["UTC", "Asia/Tokyo"])
def test_zone_is_a_parameter_and_the_session_zone_is_not(spark, session_zone):
    texts = ["2024-07-04 04:03:55", "20240704T040355", "2024-07-04T04:03:55Z"]
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        got = _column(spark, texts, lambda c: F.unix_seconds(clock.iso_instant(c, "America/Santiago")))
        stamp = _column(spark, texts[:1], lambda c: F.unix_seconds(clock.stamp_instant(c, "America/Santiago")))
        wall = _column(spark, texts[:2], lambda c: clock.iso_wall_clock(c).cast("string"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    utc = int(dt.datetime(2024, 7, 4, 4, 3, 55, tzinfo=dt.timezone.utc).timestamp())
    assert got == [utc + 4 * 3600, utc + 4 * 3600, utc] and stamp == [utc + 4 * 3600]
    assert wall == ["2024-07-04 04:03:55"] * 2
