"""Headline numbers and filter choices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.numbers import half_even, sum_or_zero


def _overall_rate(success, total):
    return F.coalesce(half_even(F.try_divide(success, total) * 100, 1), F.lit(0.0))


WEATHER = ("temperature_2m_mean", "wind_speed_10m_max")


def kpi_summary(metrics: DataFrame, features: DataFrame) -> DataFrame:
    """One row: totals from the yearly metrics, diversity and weather from features."""
    # one row per country and orbit first: distinct counts would expand every feature row
    cells = features.groupBy("pad_country_code", "mission_orbit").agg(
        *[f(c).alias(f"{f.__name__}_{c}") for c in WEATHER for f in (F.sum, F.count)],
        F.count("*").alias("n"),
    )
    seen = cells.agg(
        F.struct(
            F.countDistinct("pad_country_code").alias("countries"),
            F.countDistinct("mission_orbit").alias("orbits"),
            *[
                F.try_divide(F.sum(f"sum_{c}"), F.sum(f"count_{c}")).alias(name)
                for c, name in zip(WEATHER, ("mean_temperature", "mean_wind"))
            ],
            F.coalesce(F.sum("n"), F.lit(0)).alias("feature_rows"),
        )
    ).scalar()
    totals = metrics.agg(
        sum_or_zero(F.col("total_launches")).alias("total"),
        sum_or_zero(F.col("successful_launches")).alias("success"),
        F.countDistinct("provider_name").alias("providers"),
    )
    return (
        totals.withColumn("rate", _overall_rate(F.col("success"), F.col("total")))
        .withColumn("_seen", seen)
        .select("total", "success", "rate", "providers", "_seen.*")
    )


def hero_summary(
    metrics: DataFrame, first_year: int | None = None, last_year: int | None = None
) -> DataFrame:
    """One row: total, rate, years spanned by the chosen range (gaps count), providers."""
    first = F.min("launch_year") if first_year is None else F.lit(first_year)
    last = F.max("launch_year") if last_year is None else F.lit(last_year)
    totals = metrics.agg(
        sum_or_zero(F.col("total_launches")).alias("total"),
        sum_or_zero(F.col("successful_launches")).alias("success"),
        (last - first + 1).alias("years"),
        F.countDistinct("provider_name").alias("providers"),
    )
    rate = _overall_rate(F.col("success"), F.col("total"))
    return totals.select("total", rate.alias("rate"), "years", "providers")


def filter_options(metrics: DataFrame, features: DataFrame, images: DataFrame) -> DataFrame:
    """Values each filter offers, as ``(dim, value)``."""

    def choices(df: DataFrame, **dims: str) -> DataFrame:
        """Each table is read once: its distinct combinations give all its choices."""
        columns = [F.col(c).cast("string").alias(dim) for dim, c in dims.items()]
        apart = df.select(*columns).distinct().unpivot([], list(dims), "dim", "value")
        return apart.where(F.col("value").isNotNull()).distinct()

    return (
        choices(metrics, year="launch_year", provider="provider_name")
        .unionByName(choices(features, orbit="mission_orbit"))
        .unionByName(choices(images, source="source", image_year="launch_year"))
        .orderBy("dim", "value")
    )
