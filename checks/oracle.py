"""Expected results in DuckDB SQL, computed from ``events`` without any parsing."""

from __future__ import annotations

from feedmill.operators.quality import CHOICES, RANGES
from feedmill.operators.telemetry import FLAT_COLUMNS


def _int(expression: str) -> str:
    return f"CAST({expression} AS INTEGER)"


def _tenths(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE) / 10"


def _hundredths(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE) / 100"


def _pick(*labels: str) -> str:
    array = ", ".join(f"'{label}'" for label in labels)
    return f"([{array}])[1 + e % {len(labels)}]"


def _if(condition: str, expression: str) -> str:
    return f"CASE WHEN {condition} THEN {expression} END"


_DIAGNOSED = "route = 'stream'"
_WORKING = "e % 10 > 3"
_SOILED = f"{_WORKING} AND e % 17 <> 0"

_VALUES: dict[str, str] = {
    "vehicle_id": "'AGR-' || user_id",
    "timestamp": """CASE WHEN e % 83 = 0 THEN NULL
        WHEN e % 4 = 1 THEN date_trunc('millisecond', ts)
        WHEN e % 4 = 2 THEN date_trunc('second', ts) - INTERVAL 2 HOUR
        ELSE date_trunc('second', ts) END""",
    "gps_latitude": "CAST('-33.' || (4400 + e % 200) AS DOUBLE)",
    "gps_longitude": """CASE WHEN e % 31 = 0 THEN NULL WHEN e % 29 = 0 THEN CAST('-70.66' AS DOUBLE)
        ELSE CAST('-70.' || (6600 + e % 200) AS DOUBLE) END""",
    "engine_rpm": _int(
        "CASE WHEN e % 53 = 0 THEN NULL WHEN e % 47 = 0 THEN 1700 WHEN e % 43 = 0 THEN 1500 ELSE 1500 + e % 1001 END"
    ),
    "engine_load_percentage": _int("CASE WHEN e % 59 = 0 THEN 1 ELSE 30 + e % 66 END"),
    "fuel_level_percentage": _int("CASE WHEN e % 71 = 0 OR e % 37 = 0 THEN NULL ELSE 5 + e % 96 END"),
    "fuel_consumption_rate_l_hr": """CASE WHEN e % 89 = 0 THEN CAST(0 AS DOUBLE)
        WHEN e % 41 = 0 THEN CAST('10.5' AS DOUBLE) ELSE value END""",
    "speed_km_h": f"CASE WHEN e % 61 = 0 THEN CAST('31.5' AS DOUBLE) ELSE {_tenths('e % 601')} END",
    "odometer_km": _tenths("100000 + e % 100000"),
    "operating_hours": _tenths("15000 + e % 15000"),
    "hydraulic_pressure_psi": _int("CASE WHEN e % 79 = 0 THEN NULL ELSE 2000 + e % 1001 END"),
    "hydraulic_fluid_temp_c": _int("CASE WHEN e % 113 = 0 THEN -1 ELSE 70 + e % 31 END"),
    "engine_coolant_temp_c": _int("80 + e % 30"),
    "battery_voltage_v": _tenths("235 + e % 20"),
    "gear_engaged": _pick("Neutral", "1st", "2nd", "3rd", "4th", "Reverse", "Park"),
    "accelerator_pedal_position_percentage": _int("e % 100"),
    "brake_pedal_position_percentage": _int("CASE WHEN e % 100 < 12 THEN e % 97 ELSE 0 END"),
    "error_code": _if(f"{_DIAGNOSED} AND e % 4 <> 0", _pick("-", "P0420", "U0100", "C1234")),
    "check_engine_light": _if(_DIAGNOSED, _pick("On", "Off")),
    "low_oil_pressure": _if(_DIAGNOSED, _pick("On", "Off", "Off")),
    "engine_temp_c": _if(_DIAGNOSED, _int("85 + e % 20")),
    "transmission_temp_c": _if(_DIAGNOSED, _int("75 + e % 21")),
    "hydraulic_system_temp_c": _if(_DIAGNOSED, _int("80 + e % 19")),
    "vibration_index_x": _if(_DIAGNOSED, _hundredths("30 + e % 41")),
    "vibration_index_y": _if(_DIAGNOSED, _hundredths("30 + e % 37")),
    "vibration_index_z": _if(f"{_DIAGNOSED} AND e % 23 <> 0", _hundredths("30 + e % 43")),
    "implement_id": _if(_WORKING, "'PLNTR-' || e"),
    "section1_status": _if(_WORKING, _pick("On", "Off")),
    "section2_status": _if(_WORKING, "CASE WHEN e % 7 = 0 THEN '' ELSE 'On' END"),
    "section3_status": _if(f"{_WORKING} AND e % 3 <> 0", "'Off'"),
    "flow_rate_l_min": _if(_WORKING, _tenths("300 + e % 301")),
    "seed_rate_seeds_per_sq_m": _if(_WORKING, _tenths("50 + e % 51")),
    "yield_moisture_content_percentage": _if(_WORKING, _tenths("100 + e % 51")),
    "yield_mass_flow_rate_kg_s": _if(_WORKING, _tenths("10 + e % 21")),
    "yield_rate_per_hectare_kg_ha": _if(_WORKING, _tenths("10000 + e % 10001")),
    "soil_moisture_percentage": _if(_SOILED, _tenths("150 + e % 101")),
    "soil_temperature_c": _if(_SOILED, _tenths("180 + e % 71")),
    "nitrogen_ppm": _if(_SOILED, _int("10 + e % 31")),
    "phosphorus_ppm": _if(_SOILED, _int("5 + e % 21")),
    "potassium_ppm": _if(_SOILED, _int("20 + e % 31")),
}

_FLAT_LIST = ",\n       ".join(f'{_VALUES[name]} AS "{name}"' for name in FLAT_COLUMNS)
_NAMES = ", ".join(f'"{name}"' for name in FLAT_COLUMNS)

_TELEMETRY = f"""
WITH routed AS (
  SELECT *, event_id AS e,
         CASE WHEN event_id % 101 = 0 OR event_id % 107 = 0 OR event_id % 109 = 0 THEN NULL
              WHEN event_id % 5 = 0 THEN 'batch'
              WHEN event_id % 97 = 0 THEN 'unrouted'
              ELSE 'stream' END AS route
  FROM events),
judged AS (
  SELECT *,
         CASE WHEN e % 101 = 0 OR e % 107 = 0 THEN 'json'
              WHEN e % 109 = 0 THEN 'not_object'
              WHEN route = 'unrouted' THEN 'unrouted'
              WHEN e % 67 = 0 AND route = 'stream' THEN 'bad_container'
              WHEN e % 103 = 0 THEN 'gps'
              WHEN e % 113 = 0 AND e % 79 <> 0 THEN 'hydraulic_zero'
              WHEN e % 71 = 0 THEN 'int_range'
              WHEN e % 73 = 0 THEN 'string_type' END AS reason
  FROM routed),
flat AS (
  SELECT route,
       {_FLAT_LIST}
  FROM judged WHERE reason IS NULL)
"""

_ENRICHED_LIST = """
  CASE WHEN fuel_consumption_rate_l_hr <> 0 THEN speed_km_h / fuel_consumption_rate_l_hr END
    AS fuel_efficiency_km_per_l,
  CAST(engine_rpm AS DOUBLE) * engine_load_percentage / 100 AS engine_stress_index,
  CAST(hydraulic_pressure_psi AS DOUBLE) / (hydraulic_fluid_temp_c + 1) AS hydraulic_health_index,
  vibration_magnitude,
  CASE WHEN sections > 0 THEN flow_rate_l_min / sections END AS flow_per_section_l_min,
  CASE WHEN engine_temp_c > 100 AND vibration_magnitude > 0.7 THEN 'overheat,high_vibration'
       WHEN engine_temp_c > 100 THEN 'overheat'
       WHEN vibration_magnitude > 0.7 THEN 'high_vibration' END AS status_flags
"""

_ENRICHED = f"""{_TELEMETRY}, measured AS (
  SELECT *,
    sqrt(vibration_index_x * vibration_index_x + vibration_index_y * vibration_index_y
         + vibration_index_z * vibration_index_z) AS vibration_magnitude,
    CAST(coalesce(section1_status, '') <> '' AS INTEGER)
      + CAST(coalesce(section2_status, '') <> '' AS INTEGER)
      + CAST(coalesce(section3_status, '') <> '' AS INTEGER) AS sections
  FROM flat)
SELECT {_NAMES}, {_ENRICHED_LIST} FROM measured
"""


def _conformance() -> str:
    selects = []
    for name in FLAT_COLUMNS:
        value = f'"{name}"'
        below = above = outside = "CAST(NULL AS BIGINT)"
        if name in RANGES:
            low, high = RANGES[name]
            below = f"count(*) FILTER (WHERE {value} < CAST('{low}' AS DOUBLE))"
            above = f"count(*) FILTER (WHERE {value} > CAST('{high}' AS DOUBLE))"
        if name in CHOICES:
            listed = ", ".join(f"'{choice}'" for choice in CHOICES[name])
            outside = f"count(*) FILTER (WHERE {value} NOT IN ({listed}))"
        if name == "brake_pedal_position_percentage":
            outside = f"count(*) FILTER (WHERE accelerator_pedal_position_percentage >= 10 AND {value} <> 0)"
        selects.append(
            f"SELECT '{name}' AS column_name, count(*) AS rows, count(*) - count({value}) AS nulls, "
            f"{below} AS below, {above} AS above, {outside} AS outside FROM flat"
        )
    return _TELEMETRY + "\nUNION ALL\n".join(selects)


_FAN = """
WITH judged AS (
  SELECT *, event_id AS e,
         CASE WHEN event_id % 101 = 0 THEN 'json'
              WHEN event_id % 131 = 0 THEN 'not_object'
              WHEN event_id % 151 = 0 THEN 'json_null'
              WHEN event_id % 103 = 0 THEN 'no_timestamp'
              WHEN event_id % 107 = 0 THEN 'bad_timestamp'
              WHEN event_id % 139 = 0 THEN 'timestamp_type'
              WHEN event_id % 109 = 0 THEN 'bad_seconds'
              WHEN event_id % 113 = 0 THEN 'null_seconds'
              WHEN event_id % 127 = 0 THEN 'missing_required'
              WHEN event_id % 149 = 0 THEN 'string_type'
              WHEN event_id % 137 = 0 THEN 'int_range' END AS reason
  FROM events)
"""

_FAN_VALID = f"""{_FAN}
SELECT 'F' || user_id AS "FanID", 'R' || (e % 50) AS "RaceID",
       CASE WHEN e % 3 = 0 THEN strftime(ts, '%Y-%-m-%-d  %-H:%-M:%-S') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END
         AS "Timestamp",
       epoch_ms(date_trunc('second', ts)) AS "Timestamp_unix_ms",
       {_pick("CL", "AR", "PE", "BR", "UY")} AS "ViewerLocationCountry", event_type AS "DeviceType",
       CAST(CASE WHEN e % 11 = 0 THEN 0 WHEN e % 13 = 0 OR e % 17 = 0 THEN 12 ELSE e % 3600 END AS INTEGER)
         AS "EngagementMetric_secondswatched",
       e % 4 IN (0, 3) AS "PredictionClicked", e % 5 IN (3, 4) AS "MerchandisingClicked"
FROM judged WHERE reason IS NULL
"""

_QUAKE_TEXT = """
       CASE WHEN event_id % 19 = 0 THEN '' ELSE (event_id % 700) || ' km' END AS "Profundity",
       CAST(CAST(20 + event_id % 60 AS DOUBLE) / 10 AS VARCHAR) || ' ' || upper(event_type) AS "Magnitude",
       CAST(ts AS DATE) AS "Date",
       CAST(CASE WHEN event_id % 7 = 0 THEN hour(ts) * 3600 + minute(ts) * 60
                 ELSE hour(ts) * 3600 + minute(ts) * 60 + second(ts) END AS INTEGER) * 1000 AS "Hour",
       (event_id % 90) || ' km al "N", sector ' || user_id || CASE WHEN event_id % 23 = 0 THEN chr(10) ELSE '' END
         AS "Location",
"""
_QUAKE_TIME = """CASE WHEN event_id % 3 = 0 THEN date_trunc('millisecond', ts) ELSE date_trunc('second', ts) END"""

_QUAKES_PARQUET = f"""
SELECT {_QUAKE_TIME} AS "UTC_Date", {_QUAKE_TEXT}
       CAST(CAST(-17000 - event_id % 39000 AS DECIMAL(9,0)) * CAST('0.001' AS DECIMAL(4,3)) AS DECIMAL(5,3))
         AS "Latitude",
       CAST(CAST(-66000 - event_id % 10000 AS DECIMAL(9,0)) * CAST('0.001' AS DECIMAL(4,3)) AS DECIMAL(6,3))
         AS "Longitude"
FROM events
"""


def _half_even(ten_thousandths: str, total: int) -> str:
    """A positive count of ten-thousandths to thousandths, ties to even, as a negative decimal."""
    q, r = f"(({ten_thousandths}) // 10)", f"(({ten_thousandths}) % 10)"
    thousandths = f"({q} + CASE WHEN {r} > 5 OR ({r} = 5 AND {q} % 2 = 1) THEN 1 ELSE 0 END)"
    return f"CAST(CAST(-{thousandths} AS DECIMAL(9,0)) * CAST('0.001' AS DECIMAL(4,3)) AS DECIMAL({total},3))"


_QUAKES_AVRO = f"""
SELECT epoch_ms({_QUAKE_TIME}) AS "UTC_Date_ms", {_QUAKE_TEXT}
       {_half_even("170000 + event_id % 390000", 5)} AS "Latitude",
       {_half_even("660000 + event_id % 100000", 6)} AS "Longitude"
FROM events
"""

_ROUTES = f"""{_TELEMETRY}
SELECT coalesce(route, 'none') AS route, coalesce(reason, 'accepted') AS reason, count(*) AS rows
FROM judged GROUP BY ALL
"""


def _per_codec(rows_sql: str, codecs: list[str]) -> str:
    values = ", ".join(f"('{codec}')" for codec in codecs)
    return f"""WITH counted AS ({rows_sql})
SELECT codec, rows FROM counted, (VALUES {values}) AS codecs(codec)
"""


def _flat(route: str) -> str:
    return f"{_TELEMETRY} SELECT {_NAMES} FROM flat WHERE route = '{route}'"


ORACLES: dict[str, str] = {
    "telemetry_flat_batch": _flat("batch"),
    "telemetry_flat_stream": _flat("stream"),
    "telemetry_stream_split": f"{_TELEMETRY} SELECT {_NAMES}, route FROM flat",
    "telemetry_published": f"{_TELEMETRY} SELECT {_NAMES}, route FROM flat",
    "telemetry_compacted": f"{_TELEMETRY} SELECT {_NAMES}, route FROM flat",
    "telemetry_published_rejects": f"""{_TELEMETRY}
SELECT reason, coalesce(route, 'none') AS route, count(*) AS rows FROM judged
WHERE reason IS NOT NULL GROUP BY ALL""",
    "telemetry_enriched": _ENRICHED,
    "telemetry_routes": _ROUTES,
    "telemetry_rejects": f"""{_TELEMETRY}
SELECT reason, coalesce(route, 'none') AS route, count(*) AS rows FROM judged
WHERE reason IS NOT NULL GROUP BY ALL""",
    "telemetry_conformance": _conformance(),
    "telemetry_stream_conformance": _conformance(),
    "telemetry_parquet_roundtrip": _flat("batch"),
    "fan_valid": _FAN_VALID,
    "fan_rejects": f"{_FAN} SELECT reason, count(*) AS rows FROM judged WHERE reason IS NOT NULL GROUP BY ALL",
    "fan_avro_roundtrip": _FAN_VALID,
    "quakes_parquet_rows": _QUAKES_PARQUET,
    "quakes_split_csv": _QUAKES_PARQUET,
    "quakes_avro_rows": _QUAKES_AVRO,
    "quakes_avro_roundtrip": _QUAKES_AVRO,
    "quakes_matrix": _per_codec(
        "SELECT count(*) AS rows FROM events",
        ["avro:null", "avro:deflate", "avro:snappy", "parquet:NONE", "parquet:SNAPPY", "parquet:GZIP", "parquet:LZ4"],
    ),
    "quakes_structure": _per_codec(
        "SELECT count(*) AS rows, true AS little_read FROM events",
        [
            *["avro:null", "avro:deflate", "avro:snappy"],
            *["parquet:uncompressed", "parquet:snappy", "parquet:gzip", "parquet:lz4"],
        ],
    ).replace("SELECT codec, rows FROM", "SELECT codec, rows, little_read FROM"),
    "jsonl_roundtrip": """SELECT event_id, ts, user_id, event_type, value, props FROM events""",
    "kafka_messages": """SELECT * FROM events""",
}
