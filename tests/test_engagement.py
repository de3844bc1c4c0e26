"""Hand-worked fan engagement rows."""

import json

import pytest
from pyspark.errors import PySparkException

from feedmill.operators import engagement

ROW = {
    "FanID": "F1",
    "RaceID": "R1",
    "Timestamp": "2024-03-05 06:07:08",
    "ViewerLocationCountry": "CL",
    "DeviceType": "tv",
    "EngagementMetric_secondswatched": 61,
    "PredictionClicked": True,
    "MerchandisingClicked": False,
    "Extra": {"ignored": 1},
}


def row(**changes):
    return json.dumps({k: v for k, v in {**ROW, **changes}.items() if v is not ...})


SECONDS = "EngagementMetric_secondswatched"

REASON_CASES = [
    (row(), None), ('{"FanID"', "json"), ("", "json"), ("null", "json_null"),
    ("[]", "not_object"), ("5", "not_object"), ("false", "not_object"), ('"x"', "not_object"),
    (row(Timestamp=...), "no_timestamp"), (row(Timestamp=None), "no_timestamp"), (row(Timestamp=""), "no_timestamp"),
    (row(Timestamp=0), "no_timestamp"), (row(Timestamp=[]), "no_timestamp"),
    (row(Timestamp=17), "timestamp_type"), (row(Timestamp=["x"]), "timestamp_type"), (row(Timestamp=True), "timestamp_type"),
    (row(Timestamp="2024-03-05"), "bad_timestamp"), (row(Timestamp="2024-02-30 00:00:00"), "bad_timestamp"),
    (row(**{SECONDS: "12.5"}), "bad_seconds"), (row(**{SECONDS: ""}), "bad_seconds"), (row(**{SECONDS: float("nan")}), "bad_seconds"),
    (row(**{SECONDS: None}), "null_seconds"), (row(**{SECONDS: [1]}), "null_seconds"), (row(**{SECONDS: {}}), "null_seconds"),
    (row(**{SECONDS: float("inf")}), "non_finite_int"), (row(**{SECONDS: 2147483648}), "int_range"),
    (row(FanID=...), "missing_required"), (row(DeviceType=None), "missing_required"), (row(RaceID=7), "string_type"),
    (row(Timestamp="bad", FanID=None), "bad_timestamp"), (row(FanID=""), None),
]


def test_reasons(lines):
    rows = engagement.validate(lines([text for text, _ in REASON_CASES])).collect()
    got = [(r["line"], r["reason"]) for r in sorted(rows, key=lambda r: r["n"])]
    assert got == REASON_CASES


def test_typed_columns(lines):
    texts = [
        row(),
        row(**{SECONDS: ...}, PredictionClicked=..., MerchandisingClicked=None),
        row(**{SECONDS: " 12 "}, PredictionClicked="false", MerchandisingClicked=[]),
        row(**{SECONDS: -12.7}, PredictionClicked=0, MerchandisingClicked=0.1),
        row(**{SECONDS: True}, PredictionClicked={}, MerchandisingClicked=float("nan")),
        row(Timestamp="2024-3-5  6:7:8"),
    ]
    rows = sorted(engagement.validate(lines(texts)).collect(), key=lambda r: r["n"])
    assert [r[SECONDS] for r in rows] == [61, 0, 12, -12, 1, 61]
    assert [(r["PredictionClicked"], r["MerchandisingClicked"]) for r in rows] == [
        (True, False), (False, False), (True, False), (False, True), (False, True), (True, False),
    ]
    assert rows[5]["Timestamp"] == "2024-3-5  6:7:8"
    assert rows[5]["Timestamp_unix"].isoformat() == "2024-03-05T06:07:08"


def test_strict_mode_stops_on_rows_a_writer_cannot_take(lines):
    dropped = [text for text, reason in REASON_CASES if reason in engagement.DROP_REASONS]
    assert engagement.accepted(engagement.validate(lines([*dropped, row()]), on_crash="fail")).count() == 1
    for text, reason in REASON_CASES:
        if reason in ("not_object", "missing_required"):
            with pytest.raises(PySparkException, match=reason):
                engagement.accepted(engagement.validate(lines([text]), on_crash="fail")).collect()


def test_one_parse_no_shuffle(lines):
    rows = engagement.accepted(engagement.validate(lines([row()])))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1 and "Exchange" not in plan
