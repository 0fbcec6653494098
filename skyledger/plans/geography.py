"""Launch sites and countries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.numbers import clipped, percentage, sum_or_zero
from skyledger.operators.topk import top_n
from skyledger.plans.missions import frequency, success_by, yearly_by


def pad_stats(launches: DataFrame) -> DataFrame:
    """Volume, success rate, label and dot size of each launch site.

    The first grouping includes the location name, so that it is a hash
    aggregation (a minimum of text is not); the second sees few rows.
    """
    site = ["pad_latitude", "pad_longitude", "pad_country_code"]
    named_sites = launches.dropna(subset=site).groupBy(*site, "location_name").agg(
        F.count("*").alias("total"), sum_or_zero(F.col("is_success")).alias("success")
    )
    pads = named_sites.groupBy(*site).agg(
        F.sum("total").alias("total"),
        F.sum("success").alias("success"),
        F.min("location_name").alias("location_name"),
    )
    largest = pads.agg(F.max("total")).scalar()
    return pads.select(
        F.col("pad_latitude").alias("lat"),
        F.col("pad_longitude").alias("lon"),
        F.col("pad_country_code").alias("country"),
        "total",
        "success",
        percentage(F.col("success"), F.col("total"), 1).alias("success_rate"),
        F.coalesce("location_name", "pad_country_code").alias("label"),
        clipped(F.col("total") / largest * 20 + 5, 5.0, 25.0).alias("dot_size"),
    )


def country_top12(launches: DataFrame, n: int = 12) -> DataFrame:
    return top_n(frequency(launches, "pad_country_code"), n, "launches", "pad_country_code")


def country_success(launches: DataFrame, n: int = 10) -> DataFrame:
    return success_by(launches, "pad_country_code", n)


def country_by_year(launches: DataFrame, n: int = 4) -> DataFrame:
    return yearly_by(launches, "pad_country_code", n)
