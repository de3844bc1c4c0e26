"""Fan engagement: JSON lines to the nine required, typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions import clock
from feedmill.functions import json_values as jv
from feedmill.functions.barrier import evaluate_once
from feedmill.schemas import ENGAGEMENT

COLUMNS = ENGAGEMENT.names

# Rows of these kinds are dropped with a note.
DROP_REASONS = ["json", "json_null", "no_timestamp", "bad_timestamp", "bad_seconds"]
# Rows of these kinds stop a strict job.
CRASH_REASONS = [
    "not_object",
    "timestamp_type",
    "null_seconds",
    "non_finite_int",
    "missing_required",
    "string_type",
    "int_range",
]
REASONS = DROP_REASONS + CRASH_REASONS

_SECONDS = "EngagementMetric_secondswatched"
_CLICKS = ["PredictionClicked", "MerchandisingClicked"]
_REQUIRED_TEXT = ["FanID", "RaceID", "ViewerLocationCountry", "DeviceType"]
_KEYS = [*_REQUIRED_TEXT, "Timestamp", _SECONDS, *_CLICKS]


def _leaf(key: str) -> Column:
    return F.col("_rec")[key]


def _time_reason() -> Column:
    stamp = _leaf("Timestamp")
    return (
        F.when(~jv.truthy(stamp), "no_timestamp")
        .when(~jv.is_text(stamp), "timestamp_type")
        .when(F.col("Timestamp_unix").isNull(), "bad_timestamp")
    )


def _seconds_reason() -> Column:
    """A missing count is zero; null, lists and objects have no integer at all."""
    leaf, held = _leaf(_SECONDS), F.col("_seconds")
    countable = jv.kind(leaf).rlike("^(STRING|BOOLEAN|BIGINT|DECIMAL.*|DOUBLE)$")
    return F.when(
        leaf.isNotNull(),
        F.when(~countable, "null_seconds")
        .when(held.isNull(), "bad_seconds")
        .when(F.abs(held) == float("inf"), "non_finite_int"),
    )


def _writer_reason() -> Column:
    missing = jv.is_absent(_leaf(_REQUIRED_TEXT[0]))
    wrong = jv.not_text(_leaf(_REQUIRED_TEXT[0]))
    for key in _REQUIRED_TEXT[1:]:
        missing = missing | jv.is_absent(_leaf(key))
        wrong = wrong | jv.not_text(_leaf(key))
    return (
        F.when(missing, "missing_required")
        .when(wrong, "string_type")
        .when(jv.outside_int32(F.col("_seconds")), "int_range")
    )


def validate(lines: DataFrame, value: str = "value", zone: str = "UTC", on_crash: str = "reject") -> DataFrame:
    """Parse, type and judge fan engagement lines.

    Gives the nine columns plus ``reason`` (NULL for a good row), ``line`` and
    every other input column. With ``on_crash="fail"`` a row that a strict job
    could not survive stops the query instead of being set aside.
    """
    if on_crash not in ("reject", "fail"):
        raise ValueError("on_crash must be 'reject' or 'fail'")
    others = [c for c in lines.columns if c != value]
    keep = [*others, "line"]

    parsed = lines.select(*others, F.col(value).alias("line"), jv.parse_document(F.col(value)).alias("_parsed"))
    documents = parsed.select(
        *keep,
        F.when(jv.is_single_document(F.col("_parsed"), F.col("line")), jv.document(F.col("_parsed"))).alias("_doc"),
    )
    shape = ", ".join(f"`{key}`: variant" for key in _KEYS)
    records = documents.select(
        *keep, "_doc", F.try_variant_get(F.col("_doc"), "$", f"struct<{shape}>").alias("_rec")
    )
    seconds = [_leaf(_SECONDS)]
    numbers = records.withColumns(
        {"_plain": jv.plain_numbers([f"_rec.{_SECONDS}"]), "_odd": jv.holds_odd_number([f"_rec.{_SECONDS}"])}
    )
    typed = numbers.select(
        *keep,
        "_doc",
        "_rec",
        *[jv.text(_leaf(key)).alias(key) for key in [*_REQUIRED_TEXT, "Timestamp"]],
        F.when(
            jv.is_text(_leaf("Timestamp")), clock.stamp_instant(jv.text(_leaf("Timestamp")), zone)
        ).alias("Timestamp_unix"),
        F.when(_leaf(_SECONDS).isNull(), 0.0)
        .otherwise(F.get(jv.wholes(F.col("_plain"), F.col("_odd"), seconds), F.lit(0)))
        .alias("_seconds"),
        *[jv.truthy(_leaf(key)).alias(key) for key in _CLICKS],
    )
    reason = (
        F.when(F.col("_doc").isNull(), "json")
        .when(F.is_variant_null(F.col("_doc")), "json_null")
        .when(F.col("_rec").isNull(), "not_object")
        .otherwise(F.coalesce(_time_reason(), _seconds_reason(), _writer_reason()))
    )
    judged = typed.withColumn("reason", evaluate_once(reason)).withColumn(
        _SECONDS, F.col("_seconds").try_cast("int")
    )
    if on_crash == "fail":
        stop = F.raise_error(F.concat(F.lit("bad engagement row ("), F.col("reason"), F.lit("): "), F.col("line")))
        judged = judged.withColumn(
            "reason",
            evaluate_once(
                F.when(F.col("reason").isin(CRASH_REASONS), stop.cast("string")).otherwise(F.col("reason"))
            ),
        )
    return judged.select(*COLUMNS, "reason", *keep)


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reason").isNull()).select(*COLUMNS)


def rejected(rows: DataFrame) -> DataFrame:
    others = [c for c in rows.columns if c not in (*COLUMNS, "reason", "line")]
    return rows.where(F.col("reason").isNotNull()).select("line", "reason", *others)
