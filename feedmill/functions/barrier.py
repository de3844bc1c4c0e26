"""Ways of writing an expression that shape its plan or code, never its value."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def evaluate_once(value: Column) -> Column:
    """The same value, but filters on it stay above the projection that makes it.

    Spark pushes a filter below a deterministic projection by copying the
    expressions it tests; for a reject reason that would copy the whole parse.
    The partition id is never negative, so the value is unchanged, but it marks
    the expression as not to be copied.
    """
    return F.when(F.spark_partition_id() >= 0, value)


def any_of(conditions: list[Column]) -> Column:
    """True if one condition is. Unlike a chain of ORs, the code of ``greatest``
    is split into small methods, and NULL conditions are passed over."""
    return F.greatest(*conditions) if len(conditions) > 1 else conditions[0]


def seldom(value: Column, convert: Callable[[Column], Column]) -> Column:
    """``convert(value)``, kept out of the generated code of the hot path.

    A projection whose generated method grows past the JIT's size limit runs
    interpreted. Wrapping a long, rarely taken branch in a one-element
    ``transform`` leaves only a call in the generated code.
    """
    return F.get(F.transform(F.array(value), convert), F.lit(0))
