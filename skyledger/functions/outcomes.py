"""The two success definitions, and labels for them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def success_flag(abbrev: Column) -> Column:
    """1 when the status mentions success, else 0, unknown included (Silver)."""
    mentions = F.coalesce(F.contains(F.lower(abbrev), F.lit("success")), F.lit(False))
    return mentions.cast("int")


def strict_success_flag(abbrev: Column) -> Column:
    """1 for success, 0 for failure, null for everything else (launch frame)."""
    status = F.lower(abbrev)
    return F.when(status == "success", 1).when(status.isin("failure", "failed"), 0)


def labelled(flag: Column, yes: str, no: str, unknown: str) -> Column:
    return F.when(flag == 1, yes).when(flag == 0, no).otherwise(unknown)
