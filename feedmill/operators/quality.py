"""Reject counts, run manifests and domain conformance."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.operators.telemetry import FLAT_COLUMNS
from feedmill.sources import read_avro, read_parquet
from feedmill.sources.file_structure import FORMATS, file_structure, knows


def reject_counts(rejects: DataFrame) -> DataFrame:
    """Rejected rows per reason, and per route where rows have one."""
    keys = [c for c in ("route", "reason") if c in rejects.columns]
    return rejects.groupBy(*keys).agg(F.count("*").alias("rows"))


def route_counts(rows: DataFrame) -> DataFrame:
    """Rows per route, split into good ones and rejects by reason."""
    return rows.groupBy("route", "reason").agg(F.count("*").alias("rows"))


# ---------------------------------------------------------------- manifests


class Output(NamedTuple):
    """One written output, as a manifest row names it."""

    entity: str
    route: str | None
    path: str
    codec: str
    format: str = "parquet"


# The wording of a completion message.
_EVENT_TYPE = "data_processing_completed"
_SUCCESS = "success"


def _read_output(spark: SparkSession, output: Output) -> DataFrame:
    if output.format == "parquet":
        return read_parquet(spark, output.path)
    if output.format == "avro":
        return read_avro(spark, output.path)
    return spark.read.text(output.path)


def _counted(spark: SparkSession, outputs: list[Output]) -> DataFrame:
    """``output, rows``: by the structure of Parquet and Avro files, other outputs by a scan."""
    walked = [k for k, o in enumerate(outputs) if o.format in FORMATS and knows(spark, o.path)]
    parts = [
        _read_output(spark, o).agg(F.lit(k).alias("output"), F.count("*").alias("rows"))
        for k, o in enumerate(outputs)
        if k not in walked
    ]
    if walked:
        places = F.array(*[F.lit(k) for k in walked])
        files = file_structure(spark, [(outputs[k].path, outputs[k].format) for k in walked])
        sums = files.groupBy("output").agg(F.sum("rows").alias("rows"))
        parts.append(sums.select(F.element_at(places, F.col("output") + 1).alias("output"), "rows"))
    return reduce(DataFrame.unionAll, parts)


def manifest(spark: SparkSession, outputs: list[Output], source_system: str) -> DataFrame:
    """One completion message per output, with the rows counted on what was written.

    Parquet and Avro files are counted by their structure (``sources/file_structure.py``),
    which also finds files that are cut short. An output without files stops the job.
    """
    if not outputs:
        raise ValueError("a manifest needs at least one output")
    named = spark.createDataFrame(
        [(k, *o) for k, o in enumerate(outputs)],
        "output int, entity string, route string, path string, codec string, format string",
    )
    none = F.raise_error(F.concat(F.lit("no files in the output "), F.col("path"))).cast("bigint")
    # One row an output on either side.
    return named.join(F.broadcast(_counted(spark, outputs)), "output", "left").select(
        F.lit(_EVENT_TYPE).alias("event_type"),
        F.col("entity").alias("data_entity"),
        F.lit(_SUCCESS).alias("status"),
        F.col("path").alias("location"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("processed_at"),
        F.lit(source_system).alias("source_system"),
        "route",
        "format",
        "codec",
        F.coalesce("rows", none).alias("rows"),
    )


def file_metadata(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Path, size and modification time of the files of an output."""
    frame = _read_output(spark, Output("", None, path, "", format))
    return (
        frame.groupBy("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
        .agg(F.count("*").alias("rows"))
    )


# -------------------------------------------------------------- conformance

# Documented range of each telemetry number.
RANGES: dict[str, tuple[float, float]] = {
    "gps_latitude": (-33.46, -33.44),
    "gps_longitude": (-70.68, -70.66),
    "engine_rpm": (1500, 2500),
    "engine_load_percentage": (30, 95),
    "fuel_level_percentage": (5, 100),
    "fuel_consumption_rate_l_hr": (5.0, 20.0),
    "speed_km_h": (0.0, 60.0),
    "odometer_km": (10000.0, 20000.0),
    "operating_hours": (1500.0, 3000.0),
    "hydraulic_pressure_psi": (2000, 3000),
    "hydraulic_fluid_temp_c": (70, 100),
    "engine_coolant_temp_c": (80, 105),
    "battery_voltage_v": (23.5, 25.0),
    "accelerator_pedal_position_percentage": (0, 100),
    "brake_pedal_position_percentage": (0, 100),
    "engine_temp_c": (85, 100),
    "transmission_temp_c": (75, 95),
    "hydraulic_system_temp_c": (80, 98),
    "vibration_index_x": (0.3, 0.7),
    "vibration_index_y": (0.3, 0.7),
    "vibration_index_z": (0.3, 0.7),
    "flow_rate_l_min": (30.0, 60.0),
    "seed_rate_seeds_per_sq_m": (5.0, 10.0),
    "yield_moisture_content_percentage": (10.0, 15.0),
    "yield_mass_flow_rate_kg_s": (1.0, 3.0),
    "yield_rate_per_hectare_kg_ha": (1000.0, 2000.0),
    "soil_moisture_percentage": (15.0, 25.0),
    "soil_temperature_c": (18.0, 25.0),
    "nitrogen_ppm": (10, 40),
    "phosphorus_ppm": (5, 25),
    "potassium_ppm": (20, 50),
}

# Documented choices of each telemetry label.
CHOICES: dict[str, list[str]] = {
    "gear_engaged": ["Neutral", "1st", "2nd", "3rd", "4th", "Reverse"],
    "error_code": ["P0420", "U0100", "C1234"],
    "check_engine_light": ["On", "Off"],
    "low_oil_pressure": ["On", "Off"],
    "section1_status": ["On", "Off"],
    "section2_status": ["On", "Off"],
    "section3_status": ["On", "Off"],
}

_CHECKS = ["nulls", "below", "above", "outside"]


def _checks(name: str) -> dict[str, Column]:
    value = F.col(name)
    checks = {"nulls": value.isNull()}
    if name in RANGES:
        low, high = RANGES[name]
        # NaN counts as above: Spark sorts it after every number.
        checks |= {"below": value < low, "above": value > high}
    if name in CHOICES:
        checks["outside"] = ~value.isin(CHOICES[name])
    # The brake may be pressed only while the accelerator is nearly released.
    if name == "brake_pedal_position_percentage":
        checks["outside"] = (F.col("accelerator_pedal_position_percentage") >= 10) & (value != 0)
    return checks


def _report(flat: DataFrame, extra: dict[str, dict[str, Column]], types: dict[str, str]) -> DataFrame:
    """One pass of aggregates, folded map-side to a single row, then one row per column; what a column lacks is NULL."""
    asked = {
        name: {check: F.count_if(condition) for check, condition in _checks(name).items()} | extra.get(name, {})
        for name in FLAT_COLUMNS
    }
    named = [column.alias(f"{name}__{part}") for name, parts in asked.items() for part, column in parts.items()]
    totals = flat.agg(F.count("*").alias("_rows"), *named)
    kinds = dict.fromkeys(_CHECKS, "long") | types
    per_column = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col("_rows").alias("rows"),
            *[
                (F.col(f"{name}__{part}") if part in asked[name] else F.lit(None).cast(kind)).alias(part)
                for part, kind in kinds.items()
            ],
        )
        for name in FLAT_COLUMNS
    ]
    return totals.select(F.inline(F.array(*per_column)))


def conformance(flat: DataFrame) -> DataFrame:
    """Per column: nulls, values below or above the range, values outside the choices.

    Checks a column does not have are NULL.
    """
    return _report(flat, {}, {})


# A rank read off a sketch of this size is within about 1.3 % of the true one, folded or not.
_SKETCH_SIZE = 200


def conformance_counters(flat: DataFrame) -> DataFrame:
    """The report of some rows with, per number, a quantile sketch: to be folded with those of other rows.

    A sketch takes a few kilobytes however many rows it stands for. NaN and nulls are not in it.
    """
    sketches = {}
    for name in RANGES:
        value = F.col(name).cast("double")
        sketches[name] = {"sketch": F.kll_sketch_agg_double(F.when(~F.isnan(value), value), _SKETCH_SIZE)}
    return _report(flat, sketches, {"sketch": "binary"})


def _folded(counters: DataFrame) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ["rows", *_CHECKS]]
    return counters.groupBy("column_name").agg(*sums, F.kll_merge_agg_double("sketch", _SKETCH_SIZE).alias("sketch"))


def fold_conformance(counters: DataFrame) -> DataFrame:
    """The report of all rows from the counters of their parts; equal to ``conformance`` of the rows."""
    return counters.groupBy("column_name").agg(*[F.sum(c).alias(c) for c in ["rows", *_CHECKS]])


def _filled(sketch: Column) -> Column:
    """A sketch, or NULL if no value is in it."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, sketch)


def _cuts(sketch: Column, at: list[float]) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(float(q)) for q in at]))


def fold_quantiles(counters: DataFrame, at: list[float]) -> DataFrame:
    """Per number: how many values there are, and the values at the given ranks (NULL without values)."""
    numbers = _folded(counters.where(F.col("column_name").isin(*RANGES)))
    full = numbers.withColumn("sketch", _filled(F.col("sketch")))
    count = F.coalesce(F.kll_sketch_get_n_double("sketch"), F.lit(0).cast("long"))
    return full.select("column_name", count.alias("n_values"), _cuts(F.col("sketch"), at).alias("quantiles"))


def drift(earlier: DataFrame, later: DataFrame) -> DataFrame:
    """Per column, how the later rows differ from the earlier ones, from the counters of both.

    ``null_shift`` and ``breach_shift`` are differences of shares (of nulls; of values beyond the
    range or outside the choices); ``rank_shift`` is the largest distance between the two
    distribution functions, seen at 99 quantiles of either, and NULL where one side has no number.
    The sketches make it uncertain by some 0.03.
    """
    at = [k / 100 for k in range(1, 100)]

    def side(counters: DataFrame, name: str) -> DataFrame:
        breaches = sum((F.coalesce(c, F.lit(0)) for c in ("below", "above", "outside")), F.lit(0))
        return _folded(counters).select(
            "column_name",
            F.try_divide("nulls", "rows").alias(f"{name}_nulls"),
            F.try_divide(breaches, F.col("rows")).alias(f"{name}_breaches"),
            _cuts(_filled(F.col("sketch")), at).alias(name),
        )

    both = side(earlier, "a").join(side(later, "b"), "column_name", "full")

    def below(x: Column, side: str) -> Column:
        return F.size(F.filter(side, lambda y: y <= x))

    apart = F.transform(F.concat("a", "b"), lambda x: F.abs(below(x, "a") - below(x, "b")) / len(at))
    return both.select(
        "column_name",
        (F.col("b_nulls") - F.col("a_nulls")).alias("null_shift"),
        (F.col("b_breaches") - F.col("a_breaches")).alias("breach_shift"),
        F.array_max(apart).alias("rank_shift"),
    )
