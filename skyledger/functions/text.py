"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nonempty(value: Column) -> Column:
    """The string, or null where it is empty."""
    return F.nullif(value, F.lit(""))


def grouped(value: Column, digits: int = 0) -> Column:
    """``1234567.8`` as ``1,234,568``: thousands separators, ties to even."""
    return F.format_number(value, digits)


def fixed(value: Column, digits: int) -> Column:
    """A fixed number of decimals without thousands separators."""
    return F.replace(F.format_number(value, digits), F.lit(","), F.lit(""))


def shortened(value: Column, limit: int, tail: str) -> Column:
    """At most ``limit`` characters, with ``tail`` appended when any were cut."""
    cut = F.concat(F.substring(value, 1, limit), F.lit(tail))
    return F.when(F.length(value) > limit, cut).otherwise(value)


def first_word(value: Column) -> Column:
    return F.split_part(F.trim(value), F.lit(" "), F.lit(1))


def heading_case(value: Column) -> Column:
    """``launch_library`` as ``Launch Library``."""
    return F.initcap(F.replace(value, F.lit("_"), F.lit(" ")))


def matches_ignoring_case(value: Column, pattern: str) -> Column:
    """Regular-expression search without regard to case; null never matches."""
    return F.coalesce(value.rlike(f"(?i){pattern}"), F.lit(False))
