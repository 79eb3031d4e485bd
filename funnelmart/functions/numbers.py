"""Arithmetic that has to come out the same on every engine, and lenient conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def percentage(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` to two places, halves away from zero; NULL when ``whole`` is zero.

    Both are counts, so hundredths of a percent come from whole-number division and nothing is rounded
    twice.
    """
    part, whole = part.cast("bigint"), F.nullif(whole.cast("bigint"), F.lit(0).cast("bigint"))
    hundredths = F.call_function("div", part * 20000 + whole, whole * 2)
    return (hundredths.cast("decimal(18,0)") / 100).cast("decimal(18,2)")


def average(total: Column, count: Column) -> Column:
    """Mean of a two-place decimal column from its sum and non-null count, rounded once to six places."""
    count = F.nullif(count, F.lit(0)).cast("decimal(20,0)")
    return (total.cast("decimal(38,2)") / count).cast("decimal(22,6)")


def count_where(condition: Column, weight: Column | None = None) -> Column:
    """Number of rows (or total weight) where the condition holds; NULL on empty input."""
    return F.sum(F.when(condition, F.lit(1) if weight is None else weight).otherwise(F.lit(0)))


def lenient_cast(value: str, source: T.DataType, target: str) -> str:
    """SQL cast that turns unreadable values into NULL.

    Whole numbers may be written as ``12.0``; a fraction is rounded, halves away from zero.
    """
    if isinstance(source, T.StringType):
        value = f"nullif(trim({value}), '')"
        if target in ("int", "bigint"):
            value = f"try_cast({value} as decimal(38,6))"
    if target in ("int", "bigint") and isinstance(source, (T.StringType, T.FractionalType)):
        value = f"round({value}, 0)"
    return f"try_cast({value} as {target})"
