"""Declared input paths and output schemas.

Fixed values: the JSON paths, column names, order and types below are the
external formats of the three feeds and must stay exactly as they are.
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import types as T


class Field(NamedTuple):
    path: tuple[str, ...]
    name: str
    type: str  # string | time | real | whole


def _section(prefix: tuple[str, ...], *entries: tuple[str, str, str]) -> list[Field]:
    return [Field((*prefix, key), name, type_) for key, name, type_ in entries]


# Telemetry: JSON path -> flat column, in output order (fixed values).
TELEMETRY_FIELDS: list[Field] = [
    *_section(
        (),
        ("Vehicle_ID", "vehicle_id", "string"),
        ("Timestamp", "timestamp", "time"),
    ),
    *_section(
        ("GPS_Coordinates",),
        ("Latitude", "gps_latitude", "real"),
        ("Longitude", "gps_longitude", "real"),
    ),
    *_section(
        (),
        ("Engine_RPM", "engine_rpm", "whole"),
        ("Engine_Load_Percentage", "engine_load_percentage", "whole"),
        ("Fuel_Level_Percentage", "fuel_level_percentage", "whole"),
        ("Fuel_Consumption_Rate_L_hr", "fuel_consumption_rate_l_hr", "real"),
        ("Speed_km_h", "speed_km_h", "real"),
        ("Odometer_km", "odometer_km", "real"),
        ("Operating_Hours", "operating_hours", "real"),
        ("Hydraulic_Pressure_psi", "hydraulic_pressure_psi", "whole"),
        ("Hydraulic_Fluid_Temp_C", "hydraulic_fluid_temp_c", "whole"),
        ("Engine_Coolant_Temp_C", "engine_coolant_temp_c", "whole"),
        ("Battery_Voltage_V", "battery_voltage_v", "real"),
        ("Gear_Engaged", "gear_engaged", "string"),
        ("Accelerator_Pedal_Position_Percentage", "accelerator_pedal_position_percentage", "whole"),
        ("Brake_Pedal_Position_Percentage", "brake_pedal_position_percentage", "whole"),
    ),
    *_section(("Diagnostic_Data",), ("Error_Code", "error_code", "string")),
    *_section(
        ("Diagnostic_Data", "Warning_Lights"),
        ("CheckEngineLight", "check_engine_light", "string"),
        ("LowOilPressure", "low_oil_pressure", "string"),
    ),
    *_section(
        ("Diagnostic_Data", "Component Temperatures_C"),
        ("Engine", "engine_temp_c", "whole"),
        ("Transmission", "transmission_temp_c", "whole"),
        ("HydraulicSystem", "hydraulic_system_temp_c", "whole"),
    ),
    *_section(
        ("Diagnostic_Data", "Vibration"),
        ("Vibration_Index_X", "vibration_index_x", "real"),
        ("Vibration_Index_Y", "vibration_index_y", "real"),
        ("Vibration_Index_Z", "vibration_index_z", "real"),
    ),
    *_section(("Implement",), ("Implement_ID", "implement_id", "string")),
    *_section(
        ("Implement", "Section_Control_Status"),
        ("Section1", "section1_status", "string"),
        ("Section2", "section2_status", "string"),
        ("Section3", "section3_status", "string"),
    ),
    *_section(
        ("Implement",),
        ("Flow_Rate_L_min", "flow_rate_l_min", "real"),
        ("Seed_Rate_seeds_per_sq_m", "seed_rate_seeds_per_sq_m", "real"),
    ),
    *_section(
        ("Implement", "Yield_Monitor_Data"),
        ("Yield_Moisture_Content_Percentage", "yield_moisture_content_percentage", "real"),
        ("Yield_Mass_Flow_Rate_kg_s", "yield_mass_flow_rate_kg_s", "real"),
        ("Yield_Rate_Per_Hectare_kg_ha", "yield_rate_per_hectare_kg_ha", "real"),
    ),
    *_section(
        ("Implement", "Soil_Sensor_Data"),
        ("Soil_Moisture_Percentage", "soil_moisture_percentage", "real"),
        ("Soil_Temperature_C", "soil_temperature_c", "real"),
    ),
    *_section(
        ("Implement", "Soil_Sensor_Data", "Soil_Nutrient_Levels"),
        ("Nitrogen_ppm", "nitrogen_ppm", "whole"),
        ("Phosphorus_ppm", "phosphorus_ppm", "whole"),
        ("Potassium_ppm", "potassium_ppm", "whole"),
    ),
]

_SQL_TYPES = {
    "string": T.StringType(),
    "time": T.TimestampType(),
    "real": T.DoubleType(),
    "whole": T.IntegerType(),
}

TELEMETRY_FLAT = T.StructType([T.StructField(f.name, _SQL_TYPES[f.type]) for f in TELEMETRY_FIELDS])

# Columns computed on top of the flat row (fixed values).
DERIVED_COLUMNS = [
    "fuel_efficiency_km_per_l",
    "engine_stress_index",
    "hydraulic_health_index",
    "vibration_magnitude",
    "flow_per_section_l_min",
    "status_flags",
]

TELEMETRY_ENRICHED = T.StructType(
    TELEMETRY_FLAT.fields
    + [T.StructField(name, T.DoubleType()) for name in DERIVED_COLUMNS[:-1]]
    + [T.StructField("status_flags", T.ArrayType(T.StringType()))]
)

# Fan engagement output (fixed values).
ENGAGEMENT = T.StructType(
    [
        T.StructField("FanID", T.StringType()),
        T.StructField("RaceID", T.StringType()),
        T.StructField("Timestamp", T.StringType()),
        T.StructField("Timestamp_unix", T.TimestampType()),
        T.StructField("ViewerLocationCountry", T.StringType()),
        T.StructField("DeviceType", T.StringType()),
        T.StructField("EngagementMetric_secondswatched", T.IntegerType()),
        T.StructField("PredictionClicked", T.BooleanType()),
        T.StructField("MerchandisingClicked", T.BooleanType()),
    ]
)

# Earthquake CSV header and output order (fixed values).
QUAKE_COLUMNS = [
    "UTC_Date",
    "Profundity",
    "Magnitude",
    "Date",
    "Hour",
    "Location",
    "Latitude",
    "Longitude",
]


def _avro(name: str, fields: list[tuple[str, object]], **extra: str) -> str:
    body = {"type": "record", "name": name, **extra}
    body["fields"] = [{"name": n, "type": t} for n, t in fields]
    return json.dumps(body)


_MILLIS = {"type": "long", "logicalType": "timestamp-millis"}

# Avro record schemas written into the files (fixed values).
ENGAGEMENT_AVRO = _avro(
    "FanEngagement",
    [
        ("FanID", "string"),
        ("RaceID", "string"),
        ("Timestamp", "string"),
        ("Timestamp_unix", _MILLIS),
        ("ViewerLocationCountry", "string"),
        ("DeviceType", "string"),
        ("EngagementMetric_secondswatched", "int"),
        ("PredictionClicked", "boolean"),
        ("MerchandisingClicked", "boolean"),
    ],
)

QUAKE_AVRO = _avro(
    "Earthquake",
    [
        ("UTC_Date", _MILLIS),
        ("Profundity", "string"),
        ("Magnitude", "string"),
        ("Date", {"type": "int", "logicalType": "date"}),
        ("Hour", {"type": "int", "logicalType": "time-millis"}),
        ("Location", "string"),
        ("Latitude", {"type": "bytes", "logicalType": "decimal", "precision": 5, "scale": 3}),
        ("Longitude", {"type": "bytes", "logicalType": "decimal", "precision": 6, "scale": 3}),
    ],
    namespace="test",
    doc="Earthquake information.",
)
