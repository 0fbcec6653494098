"""RAW to Silver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.constants import (
    CATALOGUE_SOURCE,
    DEFAULT_COST_CATEGORY,
    DEFAULT_COST_PER_KG_USD,
    DEFAULT_COST_USD,
    ROCKET_COSTS,
    VENDOR_SOURCE,
)
from skyledger.functions.dates import instant, with_launch_calendar
from skyledger.functions.outcomes import success_flag
from skyledger.operators.joins import literal_lookup
from skyledger.operators.shaping import flattened
from skyledger.sources import schemas


def silver_launches(raw: DataFrame) -> DataFrame:
    """One flat row per launch record that has an id."""
    known = raw.where(F.col("id").isNotNull())
    return flattened(known, schemas.SILVER_LAUNCH_COLUMNS).select(
        "*",
        instant(F.col("launch_net_utc")).alias("launch_ts"),
        F.to_date("launch_ts").alias("launch_date"),
        F.year("launch_date").alias("launch_year"),
        success_flag(F.col("status_abbrev")).alias("is_success"),
    )


def silver_weather(raw: DataFrame) -> DataFrame:
    """One row per weather sample: the first day of its daily series."""
    known = raw.where(F.col("launch_id").isNotNull())
    sampled = flattened(known, schemas.SILVER_WEATHER_COLUMNS).select(
        "*",
        F.try_element_at("temperatures", F.lit(1)).alias("temperature_2m_mean"),
        F.try_element_at("wind_speeds", F.lit(1)).alias("wind_speed_10m_max"),
        F.col("weather_date_raw").try_cast("date").alias("weather_date"),
        F.year("weather_date").alias("weather_year"),
    )
    return sampled.drop("temperatures", "wind_speeds")


def silver_rockets(raw: DataFrame) -> DataFrame:
    return flattened(raw, schemas.SILVER_ROCKET_COLUMNS)


def silver_images(catalogue: DataFrame, vendor: DataFrame) -> DataFrame:
    """One row per image: both sources, catalogue duplicates within a record removed.

    Dates are read once per record, before it is exploded into images.
    """
    nothing = F.array(F.lit(None).cast("string"))
    from_catalogue = catalogue.select(
        F.lit(CATALOGUE_SOURCE).alias("source"),
        F.col("launch_library_id").alias("launch_id"),
        F.col("name").alias("launch_name"),
        F.col("net").alias("launch_datetime_utc"),
        F.array_except(F.array("image", "infographic"), nothing).alias("urls"),
    )
    from_vendor = vendor.select(
        F.lit(VENDOR_SOURCE).alias("source"),
        F.col("spacex_launch_id").alias("launch_id"),
        F.col("name").alias("launch_name"),
        F.col("date_utc").alias("launch_datetime_utc"),
        F.col("image_urls").alias("urls"),
    )
    dated = with_launch_calendar(from_catalogue.unionByName(from_vendor), "launch_datetime_utc")
    images = dated.select(
        "source",
        "launch_id",
        "launch_name",
        "launch_datetime_utc",
        F.explode("urls").alias("image_url"),
        "launch_date",
        "launch_year",
    )
    return images.where(F.col("image_url").isNotNull())


def silver_launch_costs(
    launches: DataFrame, price_list: Sequence[tuple[str, int, int, str]] = ROCKET_COSTS
) -> DataFrame:
    """Estimated cost of each launch, by rocket; rockets not listed get defaults."""
    priced = literal_lookup(
        launches.select(
            "launch_id", "rocket_name", "provider_name", "launch_year", "mission_type", "is_success"
        ),
        price_list,
        "rocket_name STRING, listed_cost BIGINT, listed_per_kg BIGINT, listed_category STRING",
        "rocket_name",
    )
    return priced.select(
        "launch_id",
        "rocket_name",
        "provider_name",
        "launch_year",
        "mission_type",
        "is_success",
        F.coalesce("listed_cost", F.lit(DEFAULT_COST_USD)).alias("estimated_cost_usd"),
        F.coalesce("listed_per_kg", F.lit(DEFAULT_COST_PER_KG_USD)).alias("cost_per_kg_leo_usd"),
        F.coalesce("listed_category", F.lit(DEFAULT_COST_CATEGORY)).alias("cost_category"),
    )
