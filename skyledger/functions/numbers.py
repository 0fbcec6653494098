"""Rounding, ratios and safe sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(value: Column, digits: int) -> Column:
    """Round a double to ``digits`` places, ties to even, the way numpy does it:
    scale, round to the nearest integer, scale back."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def percentage(part: Column, whole: Column, digits: int) -> Column:
    """``100 * part / whole`` rounded half-even; null where ``whole`` is zero."""
    return half_even(F.try_divide(part, whole) * 100, digits)


def sum_or_zero(value: Column) -> Column:
    """A sum that is 0, not null, for a group of nulls only."""
    return F.coalesce(F.sum(value), F.lit(0))


def money_sum(value: Column) -> Column:
    """Sum of whole amounts as an exact decimal: it cannot overflow, and does not
    depend on the order in which partial sums meet."""
    return F.sum(value.cast("decimal(20,0)"))


def exact_mean(value: Column) -> Column:
    """Mean of whole amounts: one exact sum over a count, divided as doubles."""
    return F.try_divide(money_sum(value).cast("double"), F.count(value))


def clipped(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def or_default(value: Column, default) -> Column:
    """``default`` where a number is null or zero."""
    return F.when(value.isNull() | (value == 0), F.lit(default)).otherwise(value)
