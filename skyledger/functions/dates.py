"""Instants and dates held as ISO-8601 text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(value: Column) -> Column:
    """Timestamp of an ISO-8601 text; null where it cannot be read."""
    return F.try_to_timestamp(value)


def iso_instant(value: Column) -> Column:
    """Timestamp of a text that starts with a whole ISO date. Spark would also read a
    year and month, or a time alone as one of today."""
    return F.when(value.rlike(r"^\d{4}-\d{2}-\d{2}"), instant(value))


def stated_date(value: Column) -> Column:
    """``yyyy-MM-dd`` as written in the text, in the offset the text states.

    Formatting the parsed timestamp would shift it to the session zone."""
    return F.when(iso_instant(value).isNotNull(), F.substring(value, 1, 10))


def iso_utc(value: Column) -> Column:
    """ISO-8601 text ending in ``Z``, with a fraction only if there is one."""
    fraction = F.when(F.unix_micros(value) % 1_000_000 == 0, F.lit("")).otherwise(
        F.date_format(value, ".SSSSSS")
    )
    return F.concat(F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("Z"))


def with_launch_calendar(df, text_column: str):
    """Add ``launch_date`` and ``launch_year`` from an ISO text column."""
    day = F.to_date(instant(F.col(text_column)))
    return df.select("*", day.alias("launch_date"), F.year("launch_date").alias("launch_year"))
