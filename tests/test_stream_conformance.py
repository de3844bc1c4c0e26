"""Counters of batches fold to the report of all rows; sketches against exact ranks; drift."""

import bisect

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from feedmill.operators import telemetry
from feedmill.operators.quality import RANGES, conformance, conformance_counters, drift, fold_conformance, fold_quantiles
from feedmill.sources import read_lines, stream_lines
from feedmill.streaming import published
from tests.test_jobs import TEXTS, _feed
from tests.test_published import bag, once


def _flat(spark, n, shift=0.0):
    """Rows with numbers of known spread in two columns, nulls elsewhere."""
    rows = spark.range(n, numPartitions=4).withColumns(
        {
            "speed_km_h": F.pmod(F.col("id") * 7919, F.lit(n)) / n * 60 + shift,
            "engine_rpm": (1500 + F.col("id") % 11).cast("int"),
            "soil_temperature_c": F.when(F.col("id") % 5 == 0, F.lit(float("nan"))),
            "gear_engaged": F.when(F.col("id") % 2 == 0, "1st").otherwise("Park"),
        }
    )
    missing = {
        c: F.lit(None).cast("double" if c in RANGES else "string")
        for c in telemetry.FLAT_COLUMNS
        if c not in rows.columns
    }
    return rows.withColumns(missing).select(*telemetry.FLAT_COLUMNS)


def test_folded_parts_equal_the_whole(spark):
    flat = _flat(spark, 30000)
    parts = [flat.where(F.col("engine_rpm") % 3 == k) for k in range(3)] + [flat.where("false")]
    counters = conformance_counters(parts[0])
    for part in parts[1:]:
        counters = counters.unionByName(conformance_counters(part))
    assert bag(fold_conformance(counters).select("*")) == bag(conformance(flat))
    assert bag(fold_conformance(conformance_counters(parts[3]))) == bag(conformance(parts[3]))
    at = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {r["column_name"]: r for r in fold_quantiles(counters, at).collect()}
    assert set(got) == set(RANGES)
    exact = sorted(r[0] for r in flat.select("speed_km_h").collect())
    for q, value in zip(at, got["speed_km_h"]["quantiles"]):
        assert abs(bisect.bisect(exact, value) / len(exact) - q) < 0.03
    assert got["speed_km_h"]["n_values"] == 30000
    # Neither NaN nor nulls are values.
    for name in ("soil_temperature_c", "potassium_ppm"):
        assert (got[name]["n_values"], got[name]["quantiles"]) == (0, None)


def test_drift_sees_what_moved_and_nothing_else(spark):
    before, same, moved = (conformance_counters(_flat(spark, 20000, s)) for s in (0.0, 0.0, 15.0))
    quiet = {r["column_name"]: r for r in drift(before, same).collect()}
    assert len(quiet) == len(telemetry.FLAT_COLUMNS)
    assert all(r["null_shift"] == 0 and r["breach_shift"] == 0 for r in quiet.values())
    assert quiet["speed_km_h"]["rank_shift"] < 0.05 and quiet["engine_rpm"]["rank_shift"] < 0.05
    assert quiet["potassium_ppm"]["rank_shift"] is None and quiet["gear_engaged"]["rank_shift"] is None
    loud = {r["column_name"]: r for r in drift(before, moved).collect()}
    assert abs(loud["speed_km_h"]["rank_shift"] - 0.25) < 0.05
    assert abs(loud["speed_km_h"]["breach_shift"] - 0.25) < 0.01
    assert loud["engine_rpm"]["rank_shift"] < 0.05


def test_a_stream_that_died_folds_to_the_batch_report(spark, tmp_path):
    feed, root, state = str(tmp_path / "feed"), str(tmp_path / "out"), str(tmp_path / "state")
    for k in range(3):
        _feed(tmp_path / "feed", TEXTS[k:] + TEXTS[:k], f"{k}.json")

    def run(step=lambda name, batch_id: None, conformance=True):
        lines = stream_lines(spark, feed, max_files=1)
        published.start_published(lines, root, state, shards=1, conformance=conformance, step=step).awaitTermination()

    with pytest.raises(ValueError, match="nothing is published"):
        published.read_conformance(spark, root)
    for stop in (once("written", 1), once("committed", 1)):
        with pytest.raises(StreamingQueryException):
            run(stop)
    run()
    want = bag(conformance(telemetry.accepted(telemetry.flatten(read_lines(spark, feed)))))
    counters = published.read_conformance(spark, root)
    assert bag(fold_conformance(counters)) == want and counters.select("written").distinct().count() == 3
    # The counters of the batch that died are there, and not seen.
    assert len(list((tmp_path / "out" / "conformance").iterdir())) == 4
    published.compact(spark, root)
    published.vacuum(spark, root, older_than_s=-1)
    assert len(list((tmp_path / "out" / "conformance").iterdir())) == 3
    assert bag(fold_conformance(published.read_conformance(spark, root))) == want
    # A batch without counters would leave the report short.
    _feed(tmp_path / "feed", TEXTS, "late.json")
    run(conformance=False)
    with pytest.raises(ValueError, match="without counters"):
        published.read_conformance(spark, root)
