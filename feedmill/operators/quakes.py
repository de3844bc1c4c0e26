"""Earthquake CSV: all-text rows to the two typed projections.

Both are fail-fast: the first value that cannot be converted stops the job.
They differ where the two outputs differ: the Avro projection stores an instant
and rounds decimals half to even, the Parquet projection keeps the wall clock
and refuses decimals or timestamps it would have to shorten.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions import clock

# Decimal places and total digits of the two coordinates.
_SCALE = 3
_PRECISION = {"Latitude": 5, "Longitude": 6}

_TEXT = ["Profundity", "Magnitude", "Location"]
# Wide enough that no digit is lost before the explicit rounding or refusal.
_WIDE = "decimal(38,34)"


def _must(value: Column, name: str, type_: str) -> Column:
    """The value, or stop the job naming the column and the text at fault."""
    raw = F.coalesce(F.col(name), F.lit("(missing)"))
    message = F.concat(F.lit(f"cannot convert {name}: "), raw)
    return F.coalesce(value, F.raise_error(message).cast(type_))


def _text(name: str) -> Column:
    # The CSV reader turns an empty field into NULL; the text stays empty.
    return F.coalesce(F.col(name), F.lit("")).alias(name)


def _number(name: str) -> Column:
    plain = F.replace(F.col(name), F.lit("_"), F.lit(""))
    return plain.try_cast(_WIDE)


def _coordinate(name: str, exact: bool) -> Column:
    target = f"decimal({_PRECISION[name]},{_SCALE})"
    number = _number(name)
    rounded = F.bround(number, _SCALE)
    if not exact:
        return _must(rounded.try_cast(target), name, target).alias(name)
    kept = F.when(number == rounded, rounded).try_cast(target)
    not_a_number = F.col(name).rlike(r"(?i)^\s*[+-]?s?nan[0-9]*\s*$")
    return F.when(~F.coalesce(not_a_number, F.lit(False)), _must(kept, name, target)).alias(name)


def _hour(time_type: bool) -> Column:
    millis = _must(clock.millis_of_day(F.col("Hour")), "Hour", "int")
    if not time_type:
        return millis.alias("Hour")
    seconds = (millis / 1000).cast("int")
    return F.make_time(
        F.floor(seconds / 3600).cast("int"),
        F.floor(seconds % 3600 / 60).cast("int"),
        (seconds % 60).cast("decimal(16,6)"),
    ).cast("time(0)").alias("Hour")


def avro_rows(rows: DataFrame, zone: str = "UTC") -> DataFrame:
    """Columns of the Avro record; clock text without an offset is read in ``zone``."""
    moment = _must(clock.iso_instant(F.col("UTC_Date"), zone, loose=False), "UTC_Date", "timestamp")
    # Whole milliseconds, dropping the rest toward zero.
    micros = F.unix_micros(moment)
    millis = F.when(micros < 0, -F.floor(-micros / 1000)).otherwise(F.floor(micros / 1000)).cast("long")
    return rows.select(
        F.timestamp_millis(millis).alias("UTC_Date"),
        _text("Profundity"),
        _text("Magnitude"),
        _must(clock.iso_date(F.col("Date")), "Date", "date").alias("Date"),
        _hour(time_type=False),
        _text("Location"),
        _coordinate("Latitude", exact=False),
        _coordinate("Longitude", exact=False),
    )


def parquet_rows(rows: DataFrame, time_type: bool = False) -> DataFrame:
    """Columns of the Parquet table.

    ``Hour`` is milliseconds of the day, or a TIME column with ``time_type``
    (the session must then allow that type).
    """
    wall = clock.iso_wall_clock(F.col("UTC_Date"))
    whole_millis = F.when(F.extract(F.lit("SECOND"), wall) * 1000 % 1 == 0, wall)
    return rows.select(
        _must(whole_millis, "UTC_Date", "timestamp_ntz").alias("UTC_Date"),
        _text("Profundity"),
        _text("Magnitude"),
        _must(clock.iso_date(F.col("Date")), "Date", "date").alias("Date"),
        _hour(time_type),
        _text("Location"),
        _coordinate("Latitude", exact=True),
        _coordinate("Longitude", exact=True),
    )
