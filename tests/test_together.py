"""Outputs that appear together: failures and dead drivers on the way."""

import threading
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from feedmill.plans import quake_convert
from feedmill.sinks import output_name
from feedmill.sinks.together import recover, run_jobs, write_together
from feedmill.sources import read_avro, read_parquet
from tests.test_quakes import _csv, _line


class Died(Exception):
    pass


def _shown(folder):
    return sorted(p.name for p in folder.iterdir()) if folder.exists() else []


def _rows(spark, path, extension):
    return (read_avro(spark, path) if extension == "avro" else read_parquet(spark, path)).count()


def _names(path):
    return sorted(output_name(path, "", codec, extension) for extension, codec in quake_convert.CONVERSIONS)


def test_all_seven_or_none(spark, tmp_path):
    good, out = _csv(tmp_path, *[_line(place=f"p{k}") for k in range(9)]), tmp_path / "out"
    bad = _csv(tmp_path, _line(), _line(lat="1.2345"), name="bad.csv")
    # Four decimal places are refused for Parquet alone.
    with pytest.raises(PySparkException, match="cannot convert"):
        quake_convert.convert_all(spark, [good, bad], str(out))
    assert _shown(out) == []
    outputs = quake_convert.convert_all(spark, [good], str(out), jobs=3)
    assert _shown(out) == _names(good)
    assert [_rows(spark, o.path, o.format) for o in outputs] == [9] * 7
    with pytest.raises(FileExistsError):
        quake_convert.convert_all(spark, [good], str(out))
    again = _csv(tmp_path, _line())
    outputs = quake_convert.convert_all(spark, [again], str(out), mode="overwrite")
    assert [_rows(spark, o.path, o.format) for o in outputs] == [1] * 7 and _shown(out) == _names(good)
    with pytest.raises(ValueError, match="new or replaced"):
        quake_convert.convert_all(spark, [good], str(out), mode="append")
    with pytest.raises(ValueError, match="two outputs"):
        quake_convert.convert_all(spark, [good, good], str(tmp_path / "twice"))


def test_one_write_that_fails_leaves_none(spark, tmp_path):
    rows, out = spark.range(100), tmp_path / "out"

    def fails(path):
        rows.withColumn("x", F.raise_error(F.lit("lost")).cast("int")).write.parquet(path)

    writes = {f"t{k}": rows.write.parquet for k in range(3)} | {"bad": fails}
    with pytest.raises(PySparkException, match="lost"):
        write_together(spark, str(out), writes)
    assert _shown(out) == []


@pytest.mark.parametrize("name,moved", [("decided", 0), ("moved", 1), ("moved", 7)])
def test_a_driver_that_dies_between_moves_is_recovered(spark, tmp_path, name, moved):
    path, out = _csv(tmp_path, _line(), _line()), tmp_path / "out"
    seen = []

    def step(now, _):
        seen.append(now)
        if now == name and seen.count("moved") == moved:
            raise Died

    with pytest.raises(Died):
        quake_convert.convert_all(spark, [path], str(out), step=step)
    assert len([n for n in _shown(out) if not n.startswith((".", "_"))]) == moved
    assert recover(spark, str(out)) == 1 and _shown(out) == _names(path)
    for extension, codec in quake_convert.CONVERSIONS:
        assert _rows(spark, output_name(path, str(out), codec, extension), extension) == 2
    assert recover(spark, str(out)) == 0


def test_a_journal_that_was_cut_short_decided_nothing(spark, tmp_path):
    out = tmp_path / "out"

    def step(name, path):
        raise Died

    with pytest.raises(Died):
        write_together(spark, str(out), {"t": spark.range(3).write.parquet}, step=step)
    (journal,) = out.glob("_moves-*.json")
    journal.write_text(journal.read_text()[:9])
    (out / f".{journal.name}.crc").unlink()
    assert recover(spark, str(out)) == 1 and _shown(out) == []


def test_jobs_at_a_time_and_cancelled_jobs(spark):
    running, most, lock = 0, 0, threading.Lock()

    def task():
        nonlocal running, most
        with lock:
            running, most = running + 1, max(most, running + 1)
        got = spark.range(10).count()
        time.sleep(0.2)
        with lock:
            running -= 1
        return got

    assert run_jobs(spark, [task] * 7, 3) == [10] * 7 and most <= 3
    begun = time.monotonic()
    slow = spark.range(1).select(F.java_method(F.lit("java.lang.Thread"), F.lit("sleep"), F.lit(60000).cast("long")))

    def fails():
        time.sleep(2)
        raise Died

    with pytest.raises(Died):
        run_jobs(spark, [slow.collect, fails, slow.collect], 2)
    assert time.monotonic() - begun < 40
