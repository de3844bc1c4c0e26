"""Reading dynamically typed JSON with VARIANT, the way loose scripts read it.

A line is parsed once into a VARIANT, one struct cast pulls out every wanted
leaf (still VARIANT, so missing, null and each JSON type stay apart), and the
functions below turn leaves into typed columns. All of it runs in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strict JSON plus the bare NaN / Infinity tokens many JSON writers emit.
_JSON_OPTIONS = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "true"}

# JSON texts of values that count as false.
_FALSY = r'^(null|false|""|\[\]|\{\}|-?0(\.0+)?([eE][-+]?[0-9]+)?)$'

_WHOLE_TEXT = r"^[+-]?[0-9]+(_[0-9]+)*$"
_REAL_TEXT = (
    r"^[+-]?([0-9]+(_[0-9]+)*\.?([0-9]+(_[0-9]+)*)?|\.[0-9]+(_[0-9]+)*)"
    r"([eE][+-]?[0-9]+(_[0-9]+)*)?$"
)
_EDGE_BLANKS = r"(?U)^\s+|\s+$"


def _end(line: Column) -> Column:
    """What closes the array that a line is wrapped in, as JSON text.

    It is made from the line, so a line cannot bring it along: one that smuggles
    in its own bracket, or holds several documents, does not leave exactly two
    elements with this one last.
    """
    return F.concat(F.lit('"␞'), F.xxhash64(line).cast("string"), F.lit('"'))


def parse_document(line: Column) -> Column:
    """The line's one JSON document in a two-element array, NULL if malformed."""
    wrapped = F.concat(F.lit("["), line, F.lit(","), _end(line), F.lit("]"))
    return F.from_json(wrapped, "array<variant>", _JSON_OPTIONS)


def is_single_document(parsed: Column, line: Column) -> Column:
    """True when the line was exactly one JSON document."""
    last = F.to_json(F.get(parsed, F.lit(1)))
    return F.coalesce((F.size(parsed) == 2) & (last == _end(line)), F.lit(False))


def document(parsed: Column) -> Column:
    return F.get(parsed, F.lit(0))


def kind(value: Column) -> Column:
    """SQL type name of a VARIANT; ``VOID`` for JSON null, NULL when missing."""
    return F.schema_of_variant(value)


def is_absent(value: Column) -> Column:
    """Missing or JSON null."""
    return value.isNull() | F.is_variant_null(value)


def truthy(value: Column) -> Column:
    """False for missing, null, false, zero, and empty text, list or object."""
    return F.coalesce(~F.to_json(value).rlike(_FALSY), F.lit(False))


def text(value: Column) -> Column:
    """The value as text; NULL when missing or null."""
    # Taking the quotes off the JSON text is cheaper than a VARIANT cast.
    written = F.to_json(value)
    unescaped = written.startswith('"') & ~written.contains("\\")
    return F.when(unescaped, F.substring(written, F.lit(2), F.length(written) - 2)).otherwise(
        F.try_variant_get(value, "$", "string")
    )


def is_text(value: Column) -> Column:
    return kind(value) == "STRING"


def not_text(value: Column) -> Column:
    """Present, not null, and not a JSON string."""
    written = F.to_json(value)
    # NaN and the infinities are written quoted, though they are numbers.
    spelled = written.isin('"NaN"', '"Infinity"', '"-Infinity"')
    quoted = written.startswith('"') & (~spelled | is_text(value))
    return F.coalesce((written != "null") & ~quoted, F.lit(False))


def _plain(raw: Column) -> Column:
    return F.regexp_replace(raw, _EDGE_BLANKS, "")


def whole_from_text(raw: Column) -> Column:
    """Digits with an optional sign, as a double; NULL for any other text."""
    body = _plain(raw)
    return F.when(body.rlike(_WHOLE_TEXT), F.replace(body, F.lit("_"), F.lit("")).try_cast("double"))


def real_from_text(raw: Column) -> Column:
    """Decimal or exponent notation, or a spelled nan / inf; NULL otherwise."""
    body = _plain(raw)
    return (
        F.when(body.rlike(_REAL_TEXT), F.replace(body, F.lit("_"), F.lit("")).try_cast("double"))
        .when(body.rlike(r"(?i)^[+-]?nan$"), F.lit(float("nan")))
        .when(body.rlike(r"(?i)^\+?inf(inity)?$"), F.lit(float("inf")))
        .when(body.rlike(r"(?i)^-inf(inity)?$"), F.lit(float("-inf")))
    )


def _odd_real(value: Column) -> Column:
    number = F.try_variant_get(value, "$", "double")
    return F.when(is_text(value), real_from_text(text(value))).otherwise(number)


def _odd_whole(value: Column) -> Column:
    number = F.nanvl(F.try_variant_get(value, "$", "double"), F.lit(None).cast("double"))
    return F.when(is_text(value), whole_from_text(text(value))).otherwise(number)


def _plain_number(ref: str) -> str:
    # Read from its JSON text: casting a VARIANT decimal to double sets up a new
    # cast for every value, which costs several times more.
    return f"try_cast(to_json({ref}) AS DOUBLE)"


# The next two take column references as SQL text: one expression for dozens of
# columns is built in one call instead of hundreds.


def plain_numbers(refs: list[str]) -> Column:
    """The values that are JSON numbers, as an array of doubles; NULL for the others."""
    return F.expr(f"array({', '.join(map(_plain_number, refs))})")


def holds_odd_number(refs: list[str]) -> Column:
    """True if a value is there that ``plain_numbers`` cannot read."""
    odd = [f"{_plain_number(ref)} IS NULL AND {ref} IS NOT NULL AND NOT is_variant_null({ref})" for ref in refs]
    return F.expr(f"greatest({', '.join(odd)})" if len(odd) > 1 else odd[0])


def _mended(plain: Column, odd: Column, values: list[Column], convert: Callable[[Column], Column]) -> Column:
    filled = F.zip_with(plain, F.array(*values), lambda number, value: F.coalesce(number, convert(value)))
    return F.when(odd, filled).otherwise(plain)


def reals(plain: Column, odd: Column, values: list[Column]) -> Column:
    """Tolerant floats: where ``odd``, ``plain`` completed with booleans and numeric text."""
    return _mended(plain, odd, values, _odd_real)


def wholes(plain: Column, odd: Column, values: list[Column]) -> Column:
    """Tolerant ints before truncation, held as doubles: ``plain`` completed likewise.

    Text must be plain digits. NaN has no integer, so it gives NULL. The caller
    checks the range with ``outside_int32`` and then casts to int, which
    truncates toward zero; doubles hold every int32 exactly.
    """
    return _mended(plain, odd, values, _odd_whole)


def outside_int32(held: Column) -> Column:
    return (held >= 2147483648.0) | (held <= -2147483649.0)
