"""ISO-8601 and fixed-format clock text, independent of the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedmill.functions.barrier import seldom

# The everyday shapes, which Spark's own cast reads directly.
_COMMON = r"(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}[T ]([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](\.[0-9]{1,6})?"
_COMMON_ZONED = rf"^{_COMMON}(Z|[+-](0[0-9]|1[0-7]):[0-5][0-9])$"
_COMMON_NAIVE = rf"^{_COMMON}$"

_FULL_DAY = r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{8}|[0-9]{4}-W[0-9]{2}-[0-9]|[0-9]{4}W[0-9]{3}"
_WEEK = r"[0-9]{4}-?W[0-9]{2}"
_DAY = rf"{_FULL_DAY}|{_WEEK}"
# Shortened days stand alone here: no clock may follow them.
_DAY_LOOSE = rf"{_FULL_DAY}|[0-9]{{4}}-?[0-9]{{3}}|(?:{_WEEK}|[0-9]{{4}}-[0-9]{{2}}|[0-9]{{4}})(?=$)"
_CLOCK = (
    r"[0-9]{2}(?::[0-9]{2}(?::[0-9]{2}(?:[.,][0-9]+)?)?)?"
    r"|[0-9]{4}(?:[0-9]{2}(?:[.,][0-9]+)?)?"
)
_OFFSET = r"[Zz]|[+-][0-9]{2}(?::?[0-9]{2})?"


def _number(digits: Column) -> Column:
    return digits.try_cast("int")


def _day(day: Column) -> Column:
    """Calendar, week and ordinal dates to DATE; NULL when out of range."""
    digits = F.regexp_replace(day, "[-W]", "")
    year = F.substring(digits, 1, 4)
    first = F.concat(year, F.lit("-01-01")).try_cast("date")

    week = _number(F.substring(digits, 5, 2))
    weekday = F.coalesce(_number(F.substring(digits, 7, 1)), F.lit(1))
    # ISO week 1 holds 4 January.
    week_one = F.trunc(F.date_add(first, 3), "week")
    by_week = F.when(
        week.between(1, 53) & weekday.between(1, 7),
        F.date_add(week_one, (week - 1) * 7 + weekday - 1),
    )

    nth = _number(F.substring(digits, 5, 3))
    by_ordinal = F.when(
        (nth >= 1) & (F.year(F.date_add(first, nth - 1)) == F.year(first)),
        F.date_add(first, nth - 1),
    )

    padded = F.rpad(digits, 8, "01")
    by_calendar = F.concat(
        year, F.lit("-"), F.substring(padded, 5, 2), F.lit("-"), F.substring(padded, 7, 2)
    ).try_cast("date")

    return (
        F.when(year == "0000", F.lit(None).cast("date"))
        .when(day.contains("W"), by_week)
        .when(F.length(digits) == 7, by_ordinal)
        .otherwise(by_calendar)
    )


def _micros_of_day(clock: Column, allow_24: bool) -> Column:
    """Micros since midnight of a clock text; NULL when out of range."""
    whole = F.rpad(F.replace(F.regexp_extract(clock, r"^[0-9:]+", 0), F.lit(":"), F.lit("")), 6, "0")
    micros = _number(F.rpad(F.substring(F.regexp_extract(clock, r"[.,]([0-9]+)$", 1), 1, 6), 6, "0"))
    hour, minute, second = (_number(F.substring(whole, at, 2)) for at in (1, 3, 5))
    total = (
        (hour.cast("long") * 3600 + minute * 60 + second) * 1000000 + F.coalesce(micros, F.lit(0))
    )
    last = 86400 * 1000000
    in_range = (minute < 60) & (second < 60) & ((hour < 24) | (F.lit(allow_24) & (total == last)))
    return F.when(in_range, total)


def _offset_minutes(offset: Column) -> Column:
    """Signed minutes of a zone offset; NULL when out of range."""
    digits = F.rpad(F.regexp_replace(offset, "[^0-9]", ""), 4, "0")
    hours, minutes = _number(F.substring(digits, 1, 2)), _number(F.substring(digits, 3, 2))
    sign = F.when(offset.startswith("-"), -1).otherwise(1)
    return F.when(offset.rlike("^[Zz]$"), F.lit(0)).when(
        (hours < 24) & (minutes < 60), sign * (hours * 60 + minutes)
    )


def _parts(raw: Column, loose: bool) -> tuple[Column, Column, Column, Column]:
    if loose:
        # An offset may follow the separator directly.
        pattern = rf"^({_DAY_LOOSE})(?:[\s\S](?:({_CLOCK})(?={_OFFSET}|$)|(?=[+-]))({_OFFSET})?)?$"
    else:
        pattern = rf"^({_DAY})(?:[\s\S]({_CLOCK})({_OFFSET})?)?$"
    day_text, clock_text, offset_text = (F.regexp_extract(raw, pattern, n) for n in (1, 2, 3))
    return raw.rlike(pattern), day_text, clock_text, offset_text


def _wall_micros(day_text: Column, clock_text: Column, loose: bool) -> Column:
    since_midnight = F.when(clock_text == "", F.lit(0).cast("long")).otherwise(
        _micros_of_day(clock_text, allow_24=loose)
    )
    return F.unix_date(_day(day_text)).cast("long") * 86400000000 + since_midnight


def _local_instant(wall: Column, zone: str) -> Column:
    """Wall-clock micros read in a named zone, as an instant."""
    moment = F.timestamp_micros(wall)
    if zone == "UTC":
        return moment
    # timestamp_micros is zone free, so to_utc_timestamp shifts exactly once.
    return F.to_utc_timestamp(moment, zone)


def iso_instant(raw: Column, zone: str = "UTC", loose: bool = True) -> Column:
    """ISO-8601 text to an instant; text without an offset is read in ``zone``.

    NULL when the text is no ISO date-time. ``loose`` also takes year, year-month
    and ordinal dates and 24:00.
    """
    def general(text: Column) -> Column:
        matches, day_text, clock_text, offset_text = _parts(text, loose)
        wall = _wall_micros(day_text, clock_text, loose)
        shifted = F.timestamp_micros(wall - _offset_minutes(offset_text).cast("long") * 60000000)
        return F.when(matches, F.when(offset_text == "", _local_instant(wall, zone)).otherwise(shifted))

    return (
        F.when(raw.rlike(_COMMON_ZONED), raw.try_cast("timestamp"))
        .when(raw.rlike(_COMMON_NAIVE), F.concat(raw, F.lit(f" {zone}")).try_cast("timestamp"))
        .otherwise(seldom(raw, general))
    )


def iso_wall_clock(raw: Column) -> Column:
    """ISO-8601 text to a zone-free timestamp.

    The clock reading is kept as written; text with an offset is moved to UTC.
    """

    def general(text: Column) -> Column:
        matches, day_text, clock_text, offset_text = _parts(text, loose=False)
        wall = _wall_micros(day_text, clock_text, loose=False)
        shift = F.when(offset_text == "", F.lit(0)).otherwise(_offset_minutes(offset_text))
        exact = F.when(matches, wall - shift.cast("long") * 60000000)
        day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(exact / 86400000000).cast("int"))
        seconds = F.pmod(exact, F.lit(86400000000)).cast("decimal(18,0)") / F.lit(1000000)
        # Adding an interval keeps the value zone free from end to end.
        return day.cast("timestamp_ntz") + F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")
        )

    return F.when(raw.rlike(_COMMON_NAIVE), raw.try_cast("timestamp_ntz")).otherwise(seldom(raw, general))


def iso_date(raw: Column) -> Column:
    """A bare ISO date; NULL for anything else."""
    other = seldom(raw, lambda text: F.when(text.rlike(rf"^({_DAY})$"), _day(text)))
    plain = raw.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & ~raw.startswith("0000")
    return F.when(plain, raw.try_cast("date")).otherwise(other)


def millis_of_day(raw: Column) -> Column:
    """ISO clock text to whole-second milliseconds since midnight; NULL if invalid."""

    def general(text: Column) -> Column:
        pattern = rf"^T?({_CLOCK})({_OFFSET})?$"
        clock_text, offset_text = (F.regexp_extract(text, pattern, n) for n in (1, 2))
        micros = _micros_of_day(clock_text, allow_24=False)
        good = text.rlike(pattern) & ((offset_text == "") | _offset_minutes(offset_text).isNotNull())
        return F.when(good, (F.floor(micros / 1000000) * 1000).cast("int"))

    hour, minute, second = (_number(F.substring(raw, at, 2)) for at in (1, 4, 7))
    plain = raw.rlike(r"^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](\.[0-9]+)?$")
    return F.when(plain, ((hour * 60 + minute) * 60 + second) * 1000).otherwise(seldom(raw, general))


# yyyy-mm-dd hh:mm:ss where every part after the year may drop its leading zero.
_STAMP = (
    r"^([0-9]{4})-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])"
    r"(?U:\s+)(2[0-3]|[01][0-9]|[0-9]):([0-5][0-9]|[0-9]):([0-5][0-9]|[0-9])$"
)


def stamp_instant(raw: Column, zone: str = "UTC") -> Column:
    """``yyyy-mm-dd hh:mm:ss`` text read in ``zone``; NULL if it does not fit."""
    tidy = F.regexp_replace(F.regexp_replace(raw, r"(?U)\s+", " "), "- ", "-")
    canonical = F.when(raw.rlike(_STAMP), F.concat(tidy, F.lit(f" {zone}")))
    return canonical.try_cast("timestamp")
