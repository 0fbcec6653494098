"""Repeatable numbers from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_int(value: Column, minimum: int = 1_000, span: int = 900_000) -> Column:
    """``minimum`` plus the first 32 bits of the SHA-1 of ``value`` modulo ``span``."""
    head = F.conv(F.substring(F.sha1(value), 1, 8), 16, 10).cast("long")
    return F.lit(minimum) + F.pmod(head, F.lit(span))


def shuffle_key(seed: int, value: Column) -> Column:
    """A key whose order is a repeatable shuffle of ``value``."""
    return F.sha1(F.concat(F.lit(f"{seed}:"), value.cast("string")))
