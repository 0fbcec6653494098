"""Silver to Gold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.constants import CATALOGUE_SOURCE
from skyledger.operators.joins import fan_out_keyed_left_join


def company_year_metrics(launches: DataFrame) -> DataFrame:
    """Launches, successes and success rate per year and provider. A missing year
    or provider is a group of its own. Rates here are rounded half-up."""
    grouped = launches.groupBy("launch_year", "provider_name").agg(
        F.count("launch_id").alias("total_launches"),
        F.sum("is_success").alias("successful_launches"),
    )
    rate = F.try_divide("successful_launches", "total_launches") * 100
    return grouped.withColumn("success_rate_pct", F.round(rate, 2))


def image_counts(images: DataFrame) -> DataFrame:
    return images.groupBy("source", "launch_id").agg(F.count("image_url").alias("image_count"))


def launch_features(launches: DataFrame, weather: DataFrame, images: DataFrame) -> DataFrame:
    """Launches with weather and the number of catalogue images.

    Everything meets on ``launch_id``. Images are counted per launch first (the
    source is fixed by a filter, so the count needs no other key and is already
    placed for the join). Weather may repeat an id; the launch then repeats too.
    Launches without an id meet nothing, so that images are read for the others only.
    """
    pictures = (
        images.where(F.col("source") == CATALOGUE_SOURCE)
        .groupBy("launch_id")
        .agg(F.count("image_url").alias("launch_image_count"))
    )
    samples = weather.select("launch_id", "temperature_2m_mean", "wind_speed_10m_max")
    subject = launches.select(
        "launch_id",
        "launch_name",
        "launch_date",
        "launch_year",
        "provider_name",
        "rocket_name",
        "mission_type",
        "mission_orbit",
        "pad_country_code",
        "pad_latitude",
        "pad_longitude",
        "is_success",
    )
    counted = subject.where(F.col("launch_id").isNotNull()).join(pictures, "launch_id", "left")
    lone = subject.where(F.col("launch_id").isNull())
    features = fan_out_keyed_left_join(counted, samples, "launch_id").unionByName(lone, allowMissingColumns=True)
    return features.select(
        *subject.columns,
        "temperature_2m_mean",
        "wind_speed_10m_max",
        F.coalesce("launch_image_count", F.lit(0)).alias("launch_image_count"),
    )
