"""Filters shared by the marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def year_range(df: DataFrame, first: int | None, last: int | None) -> DataFrame:
    """Rows with ``first <= launch_year <= last``; either end may be open."""
    if first is not None:
        df = df.where(F.col("launch_year") >= first)
    if last is not None:
        df = df.where(F.col("launch_year") <= last)
    return df


def members(df: DataFrame, column: str, chosen: Sequence[str] | None) -> DataFrame:
    """Rows whose value was chosen; no choice means no filter."""
    return df.where(F.col(column).isin(list(chosen))) if chosen else df


def global_filter(
    df: DataFrame,
    first_year: int | None = None,
    last_year: int | None = None,
    providers: Sequence[str] | None = None,
    orbits: Sequence[str] | None = None,
) -> DataFrame:
    """The filter bar: year range, providers and, where the table has them, orbits."""
    df = members(year_range(df, first_year, last_year), "provider_name", providers)
    return members(df, "mission_orbit", orbits) if "mission_orbit" in df.columns else df
