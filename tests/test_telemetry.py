"""Hand-worked telemetry rows: casts, routes, reject reasons and metrics."""

import copy
import json
import math

import pytest

from feedmill.operators import telemetry

# Two ordinary records with readings made up here, one with both optional parts and one with neither.
FULL = {
    "Vehicle_ID": "T-17",
    "Timestamp": "2024-11-02T18:20:07+00:00",
    "GPS_Coordinates": {"Latitude": -34.25, "Longitude": -71.5},
    "Engine_RPM": 1500,
    "Engine_Load_Percentage": 60,
    "Fuel_Level_Percentage": 72,
    "Fuel_Consumption_Rate_L_hr": 12.5,
    "Speed_km_h": 15.0,
    "Odometer_km": 4321.5,
    "Operating_Hours": 310.25,
    "Hydraulic_Pressure_psi": 2100,
    "Hydraulic_Fluid_Temp_C": 69,
    "Engine_Coolant_Temp_C": 85,
    "Battery_Voltage_V": 13.5,
    "Gear_Engaged": "2nd",
    "Accelerator_Pedal_Position_Percentage": 40,
    "Brake_Pedal_Position_Percentage": 5,
    "Diagnostic_Data": {
        "Error_Code": "C1234",
        "Warning_Lights": {"CheckEngineLight": "Off", "LowOilPressure": "On"},
        "Component Temperatures_C": {"Engine": 88, "Transmission": 75, "HydraulicSystem": 64},
        "Vibration": {"Vibration_Index_X": 0.5, "Vibration_Index_Y": 1.0, "Vibration_Index_Z": 1.0},
    },
    "Implement": {
        "Implement_ID": "I-3",
        "Section_Control_Status": {"Section1": "On", "Section2": "Off", "Section3": "Off"},
        "Flow_Rate_L_min": 48.0,
        "Seed_Rate_seeds_per_sq_m": 5.5,
        "Yield_Monitor_Data": {
            "Yield_Moisture_Content_Percentage": 15.25,
            "Yield_Mass_Flow_Rate_kg_s": 2.75,
            "Yield_Rate_Per_Hectare_kg_ha": 930.5,
        },
        "Soil_Sensor_Data": {
            "Soil_Moisture_Percentage": 22.5,
            "Soil_Temperature_C": 16.5,
            "Soil_Nutrient_Levels": {"Nitrogen_ppm": 25, "Phosphorus_ppm": 31, "Potassium_ppm": 58},
        },
    },
}
PLAIN = {**FULL, "Vehicle_ID": "T-18", "Diagnostic_Data": None, "Implement": None}
GONE = object()


def variant(base=FULL, **changes):
    """The base record with dotted paths changed (``__`` stands for a step down)."""
    record = copy.deepcopy(base)
    for path, value in changes.items():
        *steps, last = path.replace("Component_T", "Component T").split("__")
        node = record
        for step in steps:
            node = node[step]
        if value is GONE:
            del node[last]
        else:
            node[last] = value
    return json.dumps(record)


@pytest.fixture(scope="module")
def judge(spark):
    def run(texts, enriched=False, **options):
        frame = spark.createDataFrame(list(enumerate(texts)), "n int, value string")
        rows = telemetry.flatten(frame, **options)
        if enriched:
            rows = telemetry.enrich(rows)
        return [r.asDict() for r in sorted(rows.collect(), key=lambda r: r["n"])]

    return run


def test_sample_rows(judge):
    full, plain = judge([variant(), variant(PLAIN)], enriched=True)
    assert (full["route"], plain["route"]) == ("stream", "batch")
    assert full["reason"] is None and plain["reason"] is None
    assert full["timestamp"].isoformat() == "2024-11-02T18:20:07"
    assert (full["engine_rpm"], full["gps_latitude"], full["potassium_ppm"]) == (1500, -34.25, 58)
    assert full["fuel_efficiency_km_per_l"] == 1.2
    assert full["engine_stress_index"] == 900.0
    assert full["hydraulic_health_index"] == 30.0
    assert full["vibration_magnitude"] == 1.5
    assert full["flow_per_section_l_min"] == 16.0  # "Off" counts as a status
    assert full["status_flags"] == ["high_vibration"]
    for name in ("vibration_magnitude", "flow_per_section_l_min", "status_flags", "error_code", "soil_temperature_c"):
        assert plain[name] is None


WHOLE_CASES = [
    (12, 12), (12.9, 12), (-12.9, -12), (-0.5, 0), (True, 1), (False, 0), ("12", 12), (" 12 ", 12), ("+7", 7),
    ("1_000", 1000), ("1__0", None), ("12.5", None), ("1e3", None), ("", None), ("x", None), (None, None),
    ([1], None), ({"a": 1}, None), (2147483647, 2147483647), (-2147483648.9, -2147483648), (" 12 ", 12),
    ("0x10", None), ("true", None), ("Infinity", None), ("NaN", None), (float("nan"), None),
]


def test_tolerant_int(judge):
    rows = judge([variant(Engine_RPM=value) for value, _ in WHOLE_CASES])
    assert [(r["engine_rpm"], r["reason"]) for r in rows] == [(want, None) for _, want in WHOLE_CASES]


REAL_CASES = [
    (12, 12.0), (12.5, 12.5), (True, 1.0), ("12.5", 12.5), (" 1.5e3 ", 1500.0), ("1.", 1.0), (".5", 0.5), ("1_0.5", 10.5),
    ("1.5d", None), ("1.5f", None), ("0x1p3", None), ("1e", None), (".", None), ("", None), (None, None), ([], None),
    ("inf", math.inf), ("-Infinity", -math.inf), ("+INF", math.inf), (float("inf"), math.inf), (1e-320, 1e-320),
    (0.1234567890123456789, 0.1234567890123456789), (12345678901234567890, 1.2345678901234567e19),
]


def test_tolerant_float(judge):
    rows = judge([variant(Speed_km_h=value) for value, _ in REAL_CASES])
    assert [(r["speed_km_h"], r["reason"]) for r in rows] == [(want, None) for _, want in REAL_CASES]


def test_nan_is_a_float(judge):
    for row in judge([variant(Speed_km_h=float("nan")), variant(Speed_km_h=" NaN ")]):
        assert math.isnan(row["speed_km_h"]) and row["reason"] is None


def test_missing_number_is_null(judge):
    (row,) = judge([variant(Engine_RPM=GONE, Speed_km_h=GONE, Gear_Engaged=GONE, Timestamp=GONE)])
    assert [row[c] for c in ("engine_rpm", "speed_km_h", "gear_engaged", "timestamp", "reason")] == [None] * 5


REASON_CASES = [
    ("", "json"), ('{"a":1', "json"), (variant() + " x", "json"), (variant() + variant(), "json"),
    (variant() + "] x", "json"), (variant() + "],[", "json"), (variant() + "," + variant(), "json"),
    ("{'a':1}", "json"), ('{"a":01}', "json"), ('{"a":\t"\t"}', "json"),
    ("[1]", "not_object"), ("5", "not_object"), ("null", "not_object"), ('"x"', "not_object"), ("NaN", "not_object"),
    (variant(Diagnostic_Data={}), "unrouted"), (variant(Diagnostic_Data=[]), "unrouted"),
    (variant(Diagnostic_Data=0), "unrouted"), (variant(Diagnostic_Data=""), "unrouted"),
    (variant(Diagnostic_Data=False), "unrouted"), (variant(Diagnostic_Data=0.0), "unrouted"),
    (variant(Diagnostic_Data={}, GPS_Coordinates=GONE), "unrouted"),
    (variant(Diagnostic_Data="x"), "bad_container"), (variant(Diagnostic_Data=[1]), "bad_container"),
    (variant(Diagnostic_Data__Vibration=5), "bad_container"), (variant(Implement=True), "bad_container"),
    (variant(Implement__Soil_Sensor_Data__Soil_Nutrient_Levels="N"), "bad_container"),
    (variant(Implement=0), None), (variant(Implement__Yield_Monitor_Data=[]), None),
    (variant(Diagnostic_Data={"other": 1}), None), (variant(Diagnostic_Data__Warning_Lights=""), None),
    (variant(GPS_Coordinates=GONE), "gps"), (variant(GPS_Coordinates=None), "gps"),
    (variant(GPS_Coordinates="here"), "gps"), (variant(GPS_Coordinates__Latitude=GONE), "gps"),
    (variant(GPS_Coordinates__Latitude=None), None), (variant(GPS_Coordinates__Longitude="east"), None),
    (variant(Engine_RPM=float("inf")), "non_finite_int"), (variant(Engine_RPM=1).replace(': 1,', ': 1e400,', 1), "non_finite_int"),
    (variant(Speed_km_h=10**400), "non_finite_int"), (variant(Speed_km_h=1e308), None),
    (variant(Hydraulic_Fluid_Temp_C=-1), "hydraulic_zero"), (variant(Hydraulic_Fluid_Temp_C="-1"), "hydraulic_zero"),
    (variant(Hydraulic_Fluid_Temp_C=-1, Hydraulic_Pressure_psi=None), None),
    (variant(Diagnostic_Data__Vibration__Vibration_Index_X=1e200), "vibration_overflow"),
    (variant(Diagnostic_Data__Vibration__Vibration_Index_X=float("inf")), None),
    (variant(Diagnostic_Data__Vibration__Vibration_Index_X=1e200, Diagnostic_Data__Vibration__Vibration_Index_Y=None), None),
    (variant(Engine_RPM=2147483648), "int_range"), (variant(Engine_RPM="-2147483649"), "int_range"),
    (variant(Gear_Engaged=4), "string_type"), (variant(Gear_Engaged=[]), "string_type"),
    (variant(Gear_Engaged=float("nan")), "string_type"), (variant(Gear_Engaged="NaN"), None), (variant(Gear_Engaged=None), None),
    ('{"GPS_Coordinates":{"Latitude":1,"Longitude":2},"Engine_RPM":1,"Engine_RPM":2}', None),
]


def test_reasons(judge):
    rows = judge([text for text, _ in REASON_CASES])
    assert [(r["line"][-90:], r["reason"]) for r in rows] == [(text[-90:], want) for text, want in REASON_CASES]


def test_last_duplicate_key_wins(judge):
    (row,) = judge(['{"GPS_Coordinates":{"Latitude":1,"Longitude":2},"Engine_RPM":1,"Engine_RPM":2}'])
    assert row["engine_rpm"] == 2 and row["route"] == "batch"


def test_metric_edges(judge):
    rows = judge(
        [
            variant(Fuel_Consumption_Rate_L_hr=0),
            variant(Fuel_Consumption_Rate_L_hr=None),
            variant(Engine_RPM=2147483647, Engine_Load_Percentage=2147483647),
            variant(Diagnostic_Data__Vibration__Vibration_Index_X=float("nan")),
            variant(**{"Diagnostic_Data__Component_Temperatures_C__Engine": 100.9}),
            variant(**{"Diagnostic_Data__Component_Temperatures_C__Engine": 101}),
            variant(Implement__Section_Control_Status={"Section1": "", "Section2": None}),
        ],
        enriched=True,
    )
    assert rows[0]["fuel_efficiency_km_per_l"] is None and rows[1]["fuel_efficiency_km_per_l"] is None
    assert rows[2]["engine_stress_index"] == (2147483647 * 2147483647) / 100
    assert rows[3]["status_flags"] is None and math.isnan(rows[3]["vibration_magnitude"])
    assert rows[4]["status_flags"] == ["high_vibration"]
    assert rows[5]["status_flags"] == ["overheat", "high_vibration"]
    assert rows[6]["flow_per_section_l_min"] is None


def test_on_only_counts_sections_that_are_on(spark):
    frame = spark.createDataFrame([(variant(),)], "value string")
    (row,) = telemetry.accepted(telemetry.flatten(frame), enriched=True, on_only=True).collect()
    assert row["flow_per_section_l_min"] == 48.0


def test_outputs_and_rejects_cover_every_line(lines):
    rows = telemetry.flatten(lines([text for text, _ in REASON_CASES]))
    parts = [telemetry.accepted(rows, "batch"), telemetry.accepted(rows, "stream"), telemetry.rejected(rows)]
    assert sum(p.count() for p in parts) == len(REASON_CASES)
    assert len(parts[0].columns) == 41 and telemetry.accepted(rows, enriched=True).columns == telemetry.ENRICHED_COLUMNS
    assert parts[2].columns == ["line", "route", "reason", "n"]


def test_one_parse_no_shuffle(lines):
    rows = telemetry.accepted(telemetry.flatten(lines([variant()])), "stream", enriched=True)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1
    assert "Exchange" not in plan and "Python" not in plan and "ArrowEval" not in plan


def test_digits_elsewhere_do_not_reject_a_row(spark):
    digits = "9" * 400
    plain = json.dumps(FULL)
    cases = {
        "unknown": plain.replace('"Speed_km_h": 15.0', f'"Speed_km_h": NaN, "Extra": {digits}'),
        "text": plain.replace('"Speed_km_h": 15.0', '"Speed_km_h": NaN').replace('"2nd"', f'"a, {digits}, b"'),
        "infinity": plain.replace('"Speed_km_h": 15.0', f'"Speed_km_h": Infinity, "Extra": {digits}'),
        "leaf": plain.replace('"Speed_km_h": 15.0', f'"Speed_km_h": {digits}'),
    }
    lines = spark.createDataFrame(list(cases.items()), "name string, value string")
    reasons = {r["name"]: r["reason"] for r in telemetry.flatten(lines).select("name", "reason").collect()}
    assert reasons == {"unknown": None, "text": None, "infinity": None, "leaf": "non_finite_int"}


def test_a_route_is_chosen_before_leaves_are_typed(lines):
    feed = lines([text for text, _ in REASON_CASES] + [variant(PLAIN), variant()])
    for route in ("batch", "stream"):
        early = telemetry.accepted(telemetry.flatten(feed, route=route), route)
        late = telemetry.accepted(telemetry.flatten(feed), route)
        assert sorted(map(repr, early.collect())) == sorted(map(repr, late.collect()))
        plan = early._jdf.queryExecution().executedPlan().toString().splitlines()
        filters = [i for i, step in enumerate(plan) if "Filter" in step and "_route#" in step]
        typed = [i for i, step in enumerate(plan) if "AS _wholes#" in step]
        assert filters and typed and min(filters) > max(typed)
        assert sum(step.count("from_json(") for step in plan) == 1


def test_a_line_cannot_bring_its_own_end(lines):
    forged = variant() + ',"\u241eend"] junk'
    (row,) = telemetry.flatten(lines([forged])).select("reason").collect()
    assert row["reason"] == "json"
