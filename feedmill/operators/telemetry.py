"""Vehicle telemetry: JSON lines to flat, routed, optionally enriched rows.

Everything here is a narrow chain of projections, the same for a batch and a
streaming frame: one parse, no shuffle, no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions import clock, metrics
from feedmill.functions import json_values as jv
from feedmill.functions.barrier import any_of, evaluate_once
from feedmill.schemas import DERIVED_COLUMNS, TELEMETRY_FIELDS, Field

BATCH, STREAM, UNROUTED = "batch", "stream", "unrouted"

FLAT_COLUMNS = [f.name for f in TELEMETRY_FIELDS]
ENRICHED_COLUMNS = FLAT_COLUMNS + DERIVED_COLUMNS

# Reject reasons, in the order they are tried.
REASONS = [
    "json",
    "not_object",
    "unrouted",
    "bad_container",
    "gps",
    "non_finite_int",
    "hydraulic_zero",
    "vibration_overflow",
    "int_range",
    "string_type",
]

_DIAGNOSTIC = "Diagnostic_Data"
_GPS = "GPS_Coordinates"
_INF = float("inf")


def _tree(fields: list[Field]) -> dict:
    root: dict = {}
    for field in fields:
        node = root
        for key in field.path[:-1]:
            node = node.setdefault(key, {})
        node[field.path[-1]] = None
    return root


def _ddl(node: dict) -> str:
    members = (f"`{key}`: {'variant' if sub is None else _ddl(sub)}" for key, sub in node.items())
    return f"struct<{', '.join(members)}>"


_TREE = _tree(TELEMETRY_FIELDS)

# An integer too long for any double, as the value of a real leaf's own key.
_REAL_KEYS = "|".join(sorted({f.path[-1] for f in TELEMETRY_FIELDS if f.type == "real"}))
_HUGE_INTEGER = rf'"({_REAL_KEYS})"\s*:\s*-?[0-9]{{309,}}\s*[,}}]'


def _containers(node: dict, prefix: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    found = []
    for key, sub in node.items():
        if sub is not None:
            found += [(*prefix, key), *_containers(sub, (*prefix, key))]
    return found


_OPTIONAL_PARTS = [path for path in _containers(_TREE) if path != (_GPS,)]
_BY_TYPE = {t: [f for f in TELEMETRY_FIELDS if f.type == t] for t in ("string", "time", "whole", "real")}


def _ref(path: tuple[str, ...]) -> str:
    return ".".join(f"`{key}`" for key in ("_rec", *path))


def _at(path: tuple[str, ...]) -> Column:
    return F.col(_ref(path))


def _variant_at(path: tuple[str, ...]) -> Column:
    steps = "".join(f'["{key}"]' for key in path)
    return F.try_variant_get(F.col("_doc"), f"${steps}", "variant")


def _route() -> Column:
    """Which job a row belongs to, from its diagnostic part alone."""
    part = _at((_DIAGNOSTIC,))
    whole = _variant_at((_DIAGNOSTIC,))
    has_known_leaf = part.isNotNull() & any_of([_at((_DIAGNOSTIC, key)).isNotNull() for key in _TREE[_DIAGNOSTIC]])
    # The cheap test settles nearly all rows; the rest look at the value itself.
    return F.when(
        F.col("_rec").isNotNull(),
        F.when(has_known_leaf, STREAM)
        .when(jv.is_absent(whole), BATCH)
        .when(jv.truthy(whole), STREAM)
        .otherwise(UNROUTED),
    )


def _bad_container() -> Column:
    """An optional part that is neither an object nor a false-like value."""
    some_missing = any_of([_at(path).isNull() for path in _OPTIONAL_PARTS])
    # An object always gives a struct, so only parts without one can be truthy here.
    odd = F.exists(
        F.array(*[F.when(_at(path).isNull(), _variant_at(path)) for path in _OPTIONAL_PARTS]), jv.truthy
    )
    return some_missing & odd


def _no_position() -> Column:
    """The position must be an object with both keys; their values may be null."""
    return _at((_GPS, "Latitude")).isNull() | _at((_GPS, "Longitude")).isNull()


def flatten(lines: DataFrame, value: str = "value", zone: str = "UTC", route: str | None = None) -> DataFrame:
    """Parse, route, flatten and judge JSON lines.

    Gives the 41 flat columns plus ``route``, ``reason`` (NULL for a good row),
    ``line`` (the raw text) and every other input column. ``zone`` is used for
    timestamps without an offset. With ``route`` only the rows of that route are
    typed and judged; all others, unreadable lines among them, leave after the parse.

    The numeric leaves travel as two arrays, which makes the range checks one
    minimum and one maximum.
    """
    keep = [*[c for c in lines.columns if c != value], "line"]
    others = keep[:-1]

    parsed = lines.select(*others, F.col(value).alias("line"), jv.parse_document(F.col(value)).alias("_parsed"))
    documents = parsed.select(
        *keep,
        F.when(jv.is_single_document(F.col("_parsed"), F.col("line")), jv.document(F.col("_parsed"))).alias("_doc"),
    )
    records = documents.select(
        *keep, "_doc", F.try_variant_get(F.col("_doc"), "$", _ddl(_TREE)).alias("_rec")
    )

    if route is not None:
        # Marked, so that Spark does not copy the parse into a pushed-down filter.
        routed = records.select("*", evaluate_once(_route()).alias("_route"))
        records = routed.where(F.col("_route") == route).drop("_route")

    shape = (
        F.when(F.col("_doc").isNull(), "json")
        .when(F.col("_rec").isNull(), "not_object")
        .when(_bad_container(), "bad_container")
        .when(_no_position(), "gps")
    )
    time_leaf, time_name = _at(_BY_TYPE["time"][0].path), _BY_TYPE["time"][0].name
    numbers = {t: [_ref(f.path) for f in _BY_TYPE[t]] for t in ("whole", "real")}
    texts = {f.name: _at(f.path) for f in _BY_TYPE["string"]}
    held = records.select(
        *keep,
        "_doc",
        (_route() if route is None else F.lit(route)).alias("route"),
        shape.alias("_shape"),
        any_of([jv.not_text(leaf) for leaf in texts.values()]).alias("_wrong_text"),
        *[jv.plain_numbers(refs).alias(f"_{t}s") for t, refs in numbers.items()],
        *[jv.holds_odd_number(refs).alias(f"_odd_{t}s") for t, refs in numbers.items()],
        *[jv.text(leaf).alias(name) for name, leaf in texts.items()],
        F.when(~jv.not_text(time_leaf), jv.text(time_leaf)).alias(time_name),
    )

    # The many-field record stops here. The few rows with text or a boolean in a
    # number's place go back to the document for it.
    again = {t: [_variant_at(f.path) for f in _BY_TYPE[t]] for t in ("whole", "real")}
    mended = held.select(
        *keep,
        "route",
        "_shape",
        "_wrong_text",
        jv.wholes(F.col("_wholes"), F.col("_odd_wholes"), again["whole"]).alias("_wholes"),
        jv.reals(F.col("_reals"), F.col("_odd_reals"), again["real"]).alias("_reals"),
        *[f.name for f in _BY_TYPE["string"]],
        F.date_trunc("MILLISECOND", clock.iso_instant(F.col(time_name), zone)).alias(time_name),
    )

    wholes, reals = F.col("_wholes"), F.col("_reals")
    high, low = F.array_max(wholes), F.array_min(wholes)
    # NaN sorts above infinity, so it also sends a row to the look at its real keys.
    unbounded = (F.array_max(reals) >= _INF) | (F.array_min(reals) == -_INF)
    typed_columns = {f.name: F.col(f.name) for f in TELEMETRY_FIELDS}
    for n, f in enumerate(_BY_TYPE["whole"]):
        typed_columns[f.name] = F.expr(f"try_cast(get(_wholes, {n}) AS INT) AS {f.name}")
    for n, f in enumerate(_BY_TYPE["real"]):
        typed_columns[f.name] = F.expr(f"get(_reals, {n}) AS {f.name}")
    typed = mended.select(
        *keep,
        "route",
        F.when(F.col("_shape").isin("json", "not_object"), F.col("_shape"))
        .when(F.col("route") == UNROUTED, "unrouted")
        .when(F.col("_shape").isNotNull(), F.col("_shape"))
        .when((high == _INF) | (low == -_INF), "non_finite_int")
        .when(unbounded & F.col("line").rlike(_HUGE_INTEGER), "non_finite_int")
        .alias("_before"),
        F.when(jv.outside_int32(high) | jv.outside_int32(low), "int_range")
        .when(F.col("_wrong_text"), "string_type")
        .alias("_after"),
        *typed_columns.values(),
    )
    reason = (
        F.when(F.col("_before").isNotNull(), F.col("_before"))
        .when(metrics.hydraulic_divides_by_zero(), "hydraulic_zero")
        .when(metrics.vibration_overflows(), "vibration_overflow")
        .otherwise(F.col("_after"))
    )
    return typed.select(*FLAT_COLUMNS, "route", evaluate_once(reason).alias("reason"), *keep)


def enrich(rows: DataFrame, on_only: bool = False) -> DataFrame:
    """Add the six derived columns to flat rows."""
    return rows.withColumn("vibration_magnitude", metrics.vibration_magnitude()).select(
        *[c for c in rows.columns if c in FLAT_COLUMNS],
        metrics.fuel_efficiency().alias("fuel_efficiency_km_per_l"),
        metrics.engine_stress().alias("engine_stress_index"),
        metrics.hydraulic_health().alias("hydraulic_health_index"),
        "vibration_magnitude",
        metrics.flow_per_section(on_only).alias("flow_per_section_l_min"),
        metrics.status_flags(F.col("vibration_magnitude")).alias("status_flags"),
        *[c for c in rows.columns if c not in FLAT_COLUMNS],
    )


def accepted(rows: DataFrame, route: str | None = None, enriched: bool = False, on_only: bool = False) -> DataFrame:
    """Good rows, of one route if named: 41 columns, or 47 when enriched."""
    good = rows.where(F.col("reason").isNull())
    if route is not None:
        good = good.where(F.col("route") == route)
    if enriched:
        return enrich(good, on_only).select(*ENRICHED_COLUMNS)
    return good.select(*FLAT_COLUMNS)


def rejected(rows: DataFrame) -> DataFrame:
    """Every row that is in no output, with its raw line and the reason."""
    flat = set(FLAT_COLUMNS)
    others = [c for c in rows.columns if c not in flat and c not in ("line", "route", "reason")]
    return rows.where(F.col("reason").isNotNull()).select("line", "route", "reason", *others)
