"""Shaping landed records: compaction, the launch frame, images, weather targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.constants import CATALOGUE_SOURCE, VENDOR_SOURCE
from skyledger.functions.dates import iso_instant, stated_date
from skyledger.functions.outcomes import strict_success_flag
from skyledger.functions.text import nonempty
from skyledger.operators.joins import fan_out_left_join
from skyledger.operators.shaping import conform, flattened
from skyledger.sources import schemas


def compact_launches(landed: DataFrame) -> DataFrame:
    """Keep only the fields later steps need; parents that are missing appear
    with empty fields."""
    return conform(landed, T.StructType.fromDDL(schemas.LAUNCH))


def launch_frame(raw: DataFrame) -> DataFrame:
    """The flat launch table the marts use, with the three-valued success flag."""
    flat = flattened(raw, schemas.LAUNCH_FRAME_COLUMNS)
    defaults = {
        "provider_type": F.coalesce("provider_type", F.lit("Unknown")),
        "mission_orbit": F.coalesce(nonempty(F.col("mission_orbit")), "orbit_abbrev"),
        "launch_year": F.year(iso_instant(F.col("net"))),
        "is_success": strict_success_flag(F.col("status_abbrev")),
    }
    return flat.withColumns(defaults).drop("orbit_abbrev")


def with_gold_measures(frame: DataFrame, features: DataFrame) -> DataFrame:
    """Bring weather and image counts from the Gold table into the launch frame.
    A launch id that Gold repeats repeats here too."""
    measures = features.where(F.col("launch_id").isNotNull()).select(
        "launch_id", "temperature_2m_mean", "wind_speed_10m_max", "launch_image_count"
    )
    return fan_out_left_join(frame, measures, "launch_id")


def images_from_raw(catalogue: DataFrame, vendor: DataFrame) -> DataFrame:
    """Images straight from RAW: repeats are kept, rows without a year are not."""
    from_catalogue = catalogue.select(
        F.lit(CATALOGUE_SOURCE).alias("source"),
        F.coalesce("name", F.lit("")).alias("launch_name"),
        F.coalesce("net", F.lit("")).alias("net"),
        F.explode(F.array("image", "infographic")).alias("image_url"),
    )
    from_vendor = vendor.select(
        F.lit(VENDOR_SOURCE).alias("source"),
        F.coalesce("name", F.lit("")).alias("launch_name"),
        F.coalesce("date_utc", F.lit("")).alias("net"),
        F.explode("image_urls").alias("image_url"),
    )
    return (
        from_catalogue.unionByName(from_vendor)
        .where(nonempty(F.col("image_url")).isNotNull())
        .withColumn("launch_year", F.year(iso_instant(F.col("net"))))
        .where(F.col("launch_year").isNotNull())
    )


def choose_images(silver: DataFrame, raw: DataFrame) -> DataFrame:
    """Silver's images, or those of the landed records where Silver has none at all."""
    return raw if silver.isEmpty() else silver


def compact_images(launches: DataFrame) -> DataFrame:
    """Launch records that show at least one picture, in image-record form."""
    pictured = F.coalesce(nonempty(F.col("image")), nonempty(F.col("infographic"))).isNotNull()
    return launches.where(pictured).select(
        F.col("id").alias("launch_library_id"), "name", "net", "image", "infographic"
    )


def extract_launch_images(vendor_launches: DataFrame) -> DataFrame:
    """Vendor launches as image records: patches first, then photographs.
    Launches that have neither are left out."""
    patches = F.filter(
        F.array("links.patch.small", "links.patch.large"),
        lambda url: nonempty(url).isNotNull(),
    )
    photographs = F.coalesce("links.flickr.original", F.array().cast("array<string>"))
    return vendor_launches.select(
        F.col("id").alias("spacex_launch_id"),
        "name",
        "date_utc",
        "success",
        F.col("rocket").alias("rocket_id"),
        F.col("links.webcast").alias("webcast"),
        F.col("links.wikipedia").alias("wikipedia"),
        F.col("links.article").alias("article"),
        F.col("links.reddit.campaign").alias("reddit_campaign"),
        F.concat(patches, photographs).alias("image_urls"),
    ).where(F.size("image_urls") > 0)


def launchpad_coordinates(launchpads: DataFrame) -> DataFrame:
    """Launchpads that have an id."""
    return launchpads.where(nonempty(F.col("id")).isNotNull()).select(
        "id", "name", "country_code", "latitude", "longitude", "locality", "region"
    )


def launch_sites(vendor_launches: DataFrame, launchpads: DataFrame) -> DataFrame:
    """Launches with the coordinates of their pad, for weather look-ups."""
    pads = launchpad_coordinates(launchpads).select(
        F.col("id").alias("launchpad"), "latitude", "longitude"
    )
    placed = vendor_launches.select("id", F.col("date_utc").alias("net"), "launchpad")
    return placed.join(pads, "launchpad", "left").select(
        "id", "net", F.struct("latitude", "longitude").alias("pad")
    )


def weather_targets(launches: DataFrame, max_samples: int | None = None) -> DataFrame:
    """Place and date to sample for each launch that states all of them.
    ``max_samples`` is the request budget of one run."""
    ready = launches.select(
        F.col("id").alias("launch_id"),
        stated_date(F.col("net")).alias("date"),
        F.col("pad.latitude").alias("latitude"),
        F.col("pad.longitude").alias("longitude"),
    ).dropna(subset=["date", "latitude", "longitude"])
    return ready.orderBy("date", "launch_id").limit(max_samples) if max_samples else ready
