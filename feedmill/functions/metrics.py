"""Vehicle metrics over flat telemetry columns. All divisions are guarded."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Alarm limits and the labels they raise.
OVERHEAT_ABOVE_C = 100
HIGH_VIBRATION_ABOVE = 0.7
OVERHEAT = "overheat"
HIGH_VIBRATION = "high_vibration"

_EXACT_DOUBLE = 2**53


def fuel_efficiency() -> Column:
    fuel = F.col("fuel_consumption_rate_l_hr")
    return F.when(fuel != 0, F.col("speed_km_h") / fuel)


def engine_stress() -> Column:
    """rpm times load over 100, correctly rounded for any pair of ints."""
    product = F.col("engine_rpm").cast("long") * F.col("engine_load_percentage").cast("long")
    exact = (product.cast("decimal(20,0)") / F.lit(100).cast("decimal(3,0)")).cast("double")
    return F.when(F.abs(product) <= _EXACT_DOUBLE, product.cast("double") / 100.0).otherwise(exact)


def hydraulic_divides_by_zero() -> Column:
    return F.coalesce(
        (F.col("hydraulic_fluid_temp_c") == -1) & F.col("hydraulic_pressure_psi").isNotNull(), F.lit(False)
    )


def hydraulic_health() -> Column:
    temp = F.col("hydraulic_fluid_temp_c")
    return F.when(temp != -1, F.col("hydraulic_pressure_psi") / (temp.cast("double") + 1))


def _vibration() -> list[Column]:
    return [F.col(f"vibration_index_{axis}") for axis in "xyz"]


def vibration_overflows() -> Column:
    """A finite reading whose square is not finite."""
    inf = float("inf")
    x, y, z = _vibration()
    any_square = F.lit(False)
    for reading in (x, y, z):
        any_square = any_square | ((reading * reading == inf) & (F.abs(reading) != inf))
    complete = x.isNotNull() & y.isNotNull() & z.isNotNull()
    return F.when(complete, any_square).otherwise(False)


def vibration_magnitude() -> Column:
    x, y, z = _vibration()
    return F.sqrt(x * x + y * y + z * z)


def active_sections(on_only: bool = False) -> Column:
    """How many sections report a status; any non-empty text counts unless ``on_only``."""
    total = F.lit(0)
    for n in (1, 2, 3):
        status = F.coalesce(F.col(f"section{n}_status"), F.lit(""))
        counts = (status == "On") if on_only else (status != "")
        total = total + counts.cast("int")
    return total


def flow_per_section(on_only: bool = False) -> Column:
    sections = active_sections(on_only)
    return F.when(sections > 0, F.col("flow_rate_l_min") / sections)


def status_flags(magnitude: Column) -> Column:
    """Alarm labels in fixed order, NULL when none is raised."""
    hot = F.col("engine_temp_c") > OVERHEAT_ABOVE_C
    # NaN sorts above every number in Spark, so it is excluded by hand.
    shaking = ~F.isnan(magnitude) & (magnitude > HIGH_VIBRATION_ABOVE)
    flags = F.array_compact(
        F.array(F.when(hot, F.lit(OVERHEAT)), F.when(shaking, F.lit(HIGH_VIBRATION)))
    )
    return F.when(F.size(flags) > 0, flags)
