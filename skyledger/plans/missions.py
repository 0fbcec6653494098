"""Mission types and orbits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.numbers import percentage, sum_or_zero
from skyledger.operators.topk import keep_top, top_n, with_share


def frequency(launches: DataFrame, column: str) -> DataFrame:
    """How often each value occurs; nulls are left out."""
    return launches.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count("*").alias("launches")
    )


def success_by(launches: DataFrame, column: str, n: int) -> DataFrame:
    """Launches with a known outcome, successes and rate of the ``n`` largest groups."""
    grouped = launches.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count("is_success").alias("total"),
        sum_or_zero(F.col("is_success")).alias("success"),
    )
    rated = grouped.withColumn("rate", percentage(F.col("success"), F.col("total"), 1))
    return top_n(rated, n, "total", column)


def yearly_by(launches: DataFrame, column: str, n: int) -> DataFrame:
    """Launches per year of the ``n`` most frequent values. The ranking counts
    launches without a year too, so these stay in the facts until it is made."""
    facts = launches.where(F.col(column).isNotNull()).groupBy("launch_year", column).agg(
        F.count("*").alias("launches")
    )
    leaders = keep_top(facts, n, column, F.sum("launches"))
    return leaders.where(F.col("launch_year").isNotNull())


def mission_type_counts(launches: DataFrame) -> DataFrame:
    return with_share(frequency(launches, "mission_type"), "launches")


def orbit_counts(launches: DataFrame) -> DataFrame:
    return with_share(frequency(launches, "mission_orbit"), "launches")


def orbit_by_year(launches: DataFrame, n: int = 6) -> DataFrame:
    return yearly_by(launches, "mission_orbit", n)


def mission_success(launches: DataFrame, n: int = 10) -> DataFrame:
    return success_by(launches, "mission_type", n)
