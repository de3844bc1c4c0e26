"""Raw text feeds made by Spark from the whole ``events`` table.

Every event becomes one line. What each line holds follows from its
``event_id`` by remainders, so that most lines are ordinary and every special
case (a cut line, text where a number belongs, a missing part ...) turns up
throughout. ``oracle.py`` works out the expected columns from the same
remainders without ever seeing a line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.session import scratch_dir


def _object(*members: tuple[str, str]) -> str:
    """SQL for a JSON object; a member whose value is NULL is left out."""
    parts = ", ".join(f"""concat('"{key}": ', {value})""" for key, value in members)
    return f"concat('{{', concat_ws(', ', {parts}), '}}')"


def _quoted(expression: str) -> str:
    return f"""concat('"', {expression}, '"')"""


def _cases(default: str, *cases: tuple[str, str]) -> str:
    whens = " ".join(f"WHEN {condition} THEN {value}" for condition, value in cases)
    return f"CASE {whens} ELSE {default} END"


def _num(expression: str) -> str:
    return f"cast({expression} as string)"


def _pick(column: str, *labels: str) -> str:
    array = ", ".join(f"'{label}'" for label in labels)
    return f"array({array})[cast({column} % {len(labels)} as int)]"


def _telemetry_json() -> str:
    iso = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")"
    diagnostic = _object(
        ("Error_Code", _cases(_quoted(_pick("e", "-", "P0420", "U0100", "C1234")), ("e % 4 = 0", "'null'"))),
        (
            "Warning_Lights",
            _cases(
                _object(
                    ("CheckEngineLight", _quoted(_pick("e", "On", "Off"))),
                    ("LowOilPressure", _quoted(_pick("e", "On", "Off", "Off"))),
                ),
                ("e % 67 = 0", "'\"x\"'"),
            ),
        ),
        (
            "Component Temperatures_C",
            _object(
                ("Engine", _num("85 + e % 20 + 0.9D")),
                ("Transmission", _num("75 + e % 21")),
                ("HydraulicSystem", _num("80 + e % 19")),
            ),
        ),
        (
            "Vibration",
            _object(
                ("Vibration_Index_X", _num("(30 + e % 41) / 100")),
                ("Vibration_Index_Y", _num("(30 + e % 37) / 100")),
                ("Vibration_Index_Z", _cases(_num("(30 + e % 43) / 100"), ("e % 23 = 0", "NULL"))),
            ),
        ),
    )
    implement = _object(
        ("Implement_ID", _quoted("concat('PLNTR-', e)")),
        (
            "Section_Control_Status",
            _object(
                ("Section1", _quoted(_pick("e", "On", "Off"))),
                ("Section2", _cases("'\"On\"'", ("e % 7 = 0", "'\"\"'"))),
                ("Section3", _cases("'\"Off\"'", ("e % 3 = 0", "'null'"))),
            ),
        ),
        ("Flow_Rate_L_min", _num("(300 + e % 301) / 10")),
        ("Seed_Rate_seeds_per_sq_m", _num("(50 + e % 51) / 10")),
        (
            "Yield_Monitor_Data",
            _object(
                ("Yield_Moisture_Content_Percentage", _num("(100 + e % 51) / 10")),
                ("Yield_Mass_Flow_Rate_kg_s", _num("(10 + e % 21) / 10")),
                ("Yield_Rate_Per_Hectare_kg_ha", _num("(10000 + e % 10001) / 10")),
            ),
        ),
        (
            "Soil_Sensor_Data",
            _cases(
                _object(
                    ("Soil_Moisture_Percentage", _num("(150 + e % 101) / 10")),
                    ("Soil_Temperature_C", _num("(180 + e % 71) / 10")),
                    (
                        "Soil_Nutrient_Levels",
                        _object(
                            ("Nitrogen_ppm", _num("10 + e % 31")),
                            ("Phosphorus_ppm", _num("5 + e % 21")),
                            ("Potassium_ppm", _num("20 + e % 31")),
                        ),
                    ),
                ),
                ("e % 17 = 0", "'0'"),
            ),
        ),
    )
    return _object(
        ("Vehicle_ID", _quoted("concat('AGR-', user_id)")),
        (
            "Timestamp",
            _quoted(
                _cases(
                    f"concat({iso}, '+00:00')",
                    ("e % 83 = 0", "'not a time'"),
                    ("e % 40 = 3", "date_format(ts, \"yyyyMMdd'T'HHmmss'Z'\")"),
                    ("e % 4 = 1", "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")"),
                    ("e % 4 = 2", f"concat({iso}, '+02:00')"),
                )
            ),
        ),
        (
            "GPS_Coordinates",
            _cases(
                _object(
                    ("Latitude", "concat('-33.', 4400 + e % 200)"),
                    (
                        "Longitude",
                        _cases(
                            "concat('-70.', 6600 + e % 200)",
                            ("e % 31 = 0", "'null'"),
                            ("e % 29 = 0", "'\"-70.66\"'"),
                        ),
                    ),
                ),
                ("e % 103 = 0", "NULL"),
            ),
        ),
        (
            "Engine_RPM",
            _cases(
                _num("1500 + e % 1001"),
                ("e % 53 = 0", "'\"12.5\"'"),
                ("e % 47 = 0", "'\" 1700 \"'"),
                ("e % 43 = 0", "'1500.9'"),
            ),
        ),
        ("Engine_Load_Percentage", _cases(_num("30 + e % 66"), ("e % 59 = 0", "'true'"))),
        (
            "Fuel_Level_Percentage",
            _cases(_num("5 + e % 96"), ("e % 71 = 0", "'3000000000'"), ("e % 37 = 0", "NULL")),
        ),
        (
            "Fuel_Consumption_Rate_L_hr",
            _cases(_num("value"), ("e % 89 = 0", "'0'"), ("e % 41 = 0", "'\"1_0.5\"'")),
        ),
        ("Speed_km_h", _cases(_num("(e % 601) / 10"), ("e % 61 = 0", "'\" 31.5e0 \"'"))),
        ("Odometer_km", _num("(100000 + e % 100000) / 10")),
        ("Operating_Hours", _num("(15000 + e % 15000) / 10")),
        ("Hydraulic_Pressure_psi", _cases(_num("2000 + e % 1001"), ("e % 79 = 0", "'null'"))),
        ("Hydraulic_Fluid_Temp_C", _cases(_num("70 + e % 31"), ("e % 113 = 0", "'-1'"))),
        ("Engine_Coolant_Temp_C", _num("80 + e % 30")),
        ("Battery_Voltage_V", _num("(235 + e % 20) / 10")),
        (
            "Gear_Engaged",
            _cases(
                _quoted(_pick("e", "Neutral", "1st", "2nd", "3rd", "4th", "Reverse", "Park")),
                ("e % 73 = 0", "'4'"),
            ),
        ),
        ("Accelerator_Pedal_Position_Percentage", _num("e % 100")),
        ("Brake_Pedal_Position_Percentage", _cases("'0'", ("e % 100 < 12", _num("e % 97")))),
        ("Diagnostic_Data", _cases(diagnostic, ("e % 5 = 0", "'null'"), ("e % 97 = 0", "'{}'"))),
        ("Implement", _cases(implement, ("e % 10 < 3", "'null'"), ("e % 10 = 3", "'[]'"))),
    )


#: Lines of one task, and of one file of the telemetry feed.
LINES_AT_ONCE = 25_000

_counted: dict[tuple[str, str], int] = {}


def parts(spark: SparkSession, sf_dir: str) -> int:
    """Tasks that make the lines of a feed, and files of the telemetry feed: they grow with the events."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _counted:
        _counted[key] = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    return max(spark.sparkContext.defaultParallelism, -(-_counted[key] // LINES_AT_ONCE))


def _events(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """The events, dealt to tasks while they are narrow: a table of few row groups has few scan tasks.

    By hash, since a round-robin exchange sorts its rows first.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumnRenamed("event_id", "e")
    return events.repartition(tasks or parts(spark, sf_dir), "e", "ts", "user_id")


def telemetry_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One telemetry line per event."""
    documents = _events(spark, sf_dir).select("e", F.expr(_telemetry_json()).alias("j"))
    return documents.select(
        F.expr(
            """CASE WHEN e % 101 = 0 THEN left(j, 40)
                    WHEN e % 107 = 0 THEN concat(j, ' ', j)
                    WHEN e % 109 = 0 THEN concat('[', j, ']')
                    ELSE j END"""
        ).alias("value")
    )


def _fan_json() -> str:
    return _object(
        ("FanID", _cases(_quoted("concat('F', user_id)"), ("e % 127 = 0", "'null'"))),
        ("RaceID", _cases(_quoted("concat('R', e % 50)"), ("e % 149 = 0", "'7'"))),
        (
            "Timestamp",
            _cases(
                _quoted("date_format(ts, 'yyyy-MM-dd HH:mm:ss')"),
                ("e % 103 = 0", "NULL"),
                ("e % 107 = 0", _quoted("date_format(ts, 'yyyy/MM/dd HH:mm:ss')")),
                ("e % 139 = 0", _num("e + 1")),
                ("e % 3 = 0", _quoted("date_format(ts, 'yyyy-M-d  H:m:s')")),
            ),
        ),
        ("ViewerLocationCountry", _quoted(_pick("e", "CL", "AR", "PE", "BR", "UY"))),
        ("DeviceType", _quoted("event_type")),
        (
            "EngagementMetric_secondswatched",
            _cases(
                _num("e % 3600"),
                ("e % 109 = 0", "'\"12.5\"'"),
                ("e % 113 = 0", "'null'"),
                ("e % 137 = 0", "'3000000000'"),
                ("e % 11 = 0", "NULL"),
                ("e % 13 = 0", "'\" 12 \"'"),
                ("e % 17 = 0", "'12.7'"),
            ),
        ),
        ("PredictionClicked", _cases("'\"false\"'", ("e % 4 = 0", "'true'"), ("e % 4 = 1", "'0'"), ("e % 4 = 2", "NULL"))),
        (
            "MerchandisingClicked",
            _cases("'[0]'", ("e % 5 = 0", "'false'"), ("e % 5 = 1", "'\"\"'"), ("e % 5 = 2", "'{}'"), ("e % 5 = 3", "'0.5'")),
        ),
        ("Extra", _num("value")),
    )


def fan_lines(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """One fan engagement line per event."""
    documents = _events(spark, sf_dir, tasks).select("e", F.expr(_fan_json()).alias("j"))
    return documents.select(
        F.expr(
            """CASE WHEN e % 101 = 0 THEN concat(left(j, 30), '}')
                    WHEN e % 131 = 0 THEN concat('[', j, ']')
                    WHEN e % 151 = 0 THEN 'null'
                    ELSE j END"""
        ).alias("value")
    )


def quake_table(spark: SparkSession, sf_dir: str, decimals: int = 3, tasks: int | None = None) -> DataFrame:
    """One earthquake record per event as text columns, one column more than needed.

    Coordinates carry ``decimals`` places; with four, a tenth of them lie half-way.
    """
    step = 10**decimals
    return _events(spark, sf_dir, tasks).select(
        F.expr(
            """CASE WHEN e % 3 = 0 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS")
                    ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END"""
        ).alias("UTC_Date"),
        F.expr("CASE WHEN e % 19 = 0 THEN '' ELSE concat(e % 700, ' km') END").alias("Profundity"),
        F.expr("e").cast("string").alias("Row"),
        F.expr("concat(cast((20 + e % 60) / 10 as string), ' ', upper(event_type))").alias("Magnitude"),
        F.expr("date_format(ts, 'yyyy-MM-dd')").alias("Date"),
        F.expr("CASE WHEN e % 7 = 0 THEN date_format(ts, 'HH:mm') ELSE date_format(ts, 'HH:mm:ss.SSS') END").alias("Hour"),
        F.expr("""concat(e % 90, ' km al "N", sector ', user_id, CASE WHEN e % 23 = 0 THEN '\n' ELSE '' END)""").alias("Location"),
        F.expr(f"cast(cast(-17 * {step} - e % (39 * {step}) as decimal(12,0)) / {step} as decimal(9,{decimals}))")
        .cast("string")
        .alias("Latitude"),
        F.expr(f"cast(cast(-66 * {step} - e % (10 * {step}) as decimal(12,0)) / {step} as decimal(9,{decimals}))")
        .cast("string")
        .alias("Longitude"),
    )


_written: dict[tuple[str, str, str], str] = {}


def feed_folder(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The folder of a feed's files in the shared scratch folder, written once per session.

    Telemetry lines are long and much alike: their files are compressed, and so small that a task reads one whole.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        folder = scratch_dir(spark, name)
        files = spark.sparkContext.defaultParallelism
        if name == "telemetry":
            telemetry_lines(spark, sf_dir).write.text(folder, compression="gzip")
        elif name == "fan":
            fan_lines(spark, sf_dir, files).write.text(folder)
        else:
            decimals = int(name.removeprefix("quakes"))
            writer = quake_table(spark, sf_dir, decimals, files).write.option("header", True).option("escape", '"')
            keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
            writer.options(**keep).csv(folder)
        _written[key] = folder
    return _written[key]
