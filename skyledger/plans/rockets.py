"""Rocket comparison and launch scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.constants import DEFAULT_BASE_RATE, MISSING_MARK, ROCKET_SPEC_HEADINGS
from skyledger.functions.numbers import half_even, or_default
from skyledger.functions.scoring import (
    factor_band,
    probability_band,
    success_probability,
    temperature_factor,
    wind_factor,
)
from skyledger.functions.text import grouped, shortened


def rocket_chart_values(rockets: DataFrame) -> DataFrame:
    """Values of the bar charts; a null is a bar that is not drawn."""
    return rockets.select(
        F.col("rocket_name").alias("name"),
        (F.col("mass_kg") / 1000).alias("mass_t"),
        (F.col("cost_per_launch_usd") / 1_000_000).alias("cost_m"),
        F.col("height_meters").alias("height"),
    )


def rocket_radar(rockets: DataFrame) -> DataFrame:
    """Five measures scaled to [0, 1] for rockets of known height and mass."""
    cost = or_default(F.col("cost_per_launch_usd"), 1)
    stages = or_default(F.col("stages"), 1)
    full = F.lit(1.0)
    return rockets.dropna(subset=["height_meters", "mass_kg"]).select(
        F.col("rocket_name").alias("name"),
        F.least(F.col("height_meters") / 120, full).alias("h"),
        F.least(F.col("mass_kg") / 1_400_000, full).alias("m"),
        (F.coalesce("success_rate_pct", F.lit(0.0)) / 100).alias("sr"),
        (full - F.least(cost / 100_000_000, full)).alias("eco"),
        F.least(stages / 3, full).alias("stage"),
    )


def rocket_specs(rockets: DataFrame) -> DataFrame:
    """The specification table as displayed."""
    mark = F.lit(MISSING_MARK)
    dollars = F.concat(F.lit("$"), grouped(F.col("cost_per_launch_usd")))
    shown = rockets.select(*ROCKET_SPEC_HEADINGS).withColumns(
        {
            "mass_kg": F.coalesce(grouped(F.col("mass_kg")), mark),
            "cost_per_launch_usd": F.coalesce(dollars, mark),
        }
    )
    return shown.withColumnsRenamed(ROCKET_SPEC_HEADINGS)


def rocket_cards(rockets: DataFrame) -> DataFrame:
    """Facts and a short description of each rocket."""
    return rockets.select(
        "rocket_name",
        F.concat(grouped(F.col("height_meters")), F.lit(" m")).alias("height"),
        F.concat(grouped(F.col("mass_kg") / 1000), F.lit(" t")).alias("mass"),
        F.concat(grouped(F.col("success_rate_pct")), F.lit("%")).alias("success_rate"),
        F.concat(F.lit("$"), grouped(F.col("cost_per_launch_usd") / 1_000_000), F.lit("M")).alias(
            "cost"
        ),
        shortened(F.col("description"), 240, "…").alias("description"),
    )


def rocket_first_image(raw_rockets: DataFrame, name: str | None = None) -> DataFrame:
    """The first picture of each rocket, or of the one asked for."""
    if name is not None:
        raw_rockets = raw_rockets.where(F.col("name") == name)
    return raw_rockets.select(
        F.col("name").alias("rocket_name"),
        F.try_element_at("flickr_images", F.lit(1)).alias("image_url"),
    )


def launch_probability(features: DataFrame, rockets: DataFrame) -> DataFrame:
    """Success score of every launch with its three factors.

    Rates are reduced to one row per rocket name, so the join cannot multiply
    launches; whether it is a broadcast is left to the measured table size.
    """
    rates = rockets.where(F.col("rocket_name").isNotNull()).groupBy("rocket_name").agg(
        F.min_by("success_rate_pct", "spacex_rocket_id").alias("rate")
    )
    subject = features.select(
        "launch_id", "rocket_name", "temperature_2m_mean", "wind_speed_10m_max"
    )
    factors = subject.join(rates, "rocket_name", "left").select(
        "launch_id",
        F.coalesce(F.col("rate") / 100, F.lit(DEFAULT_BASE_RATE)).alias("base"),
        temperature_factor(F.col("temperature_2m_mean")).alias("temp_factor"),
        wind_factor(F.col("wind_speed_10m_max")).alias("wind_factor"),
    )
    probability = success_probability(F.col("base"), F.col("temp_factor"), F.col("wind_factor"))
    return (
        factors.withColumn("probability", probability)
        .withColumn("probability_pct", half_even(F.col("probability") * 100, 1))
        .withColumn("band", probability_band(F.col("probability_pct")))
        .withColumn("temp_band", factor_band(F.col("temp_factor"), 0.75))
        .withColumn("wind_band", factor_band(F.col("wind_factor"), 0.65))
    )
