"""Synthetic expansion: variants of real launches up to a target count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger import constants as K
from skyledger.functions.dates import instant, iso_utc
from skyledger.functions.hashing import stable_int
from skyledger.functions.missions import mission_profile
from skyledger.functions.text import nonempty
from skyledger.operators.indexing import with_row_index
from skyledger.operators.shaping import conform
from skyledger.plans.launch_frame import launchpad_coordinates
from skyledger.sources import schemas


def synthetic_expand(
    real: DataFrame, seeds: DataFrame, launchpads: DataFrame, rockets: DataFrame, target: int
) -> DataFrame:
    """``real`` launch records, and synthetic ones until there are ``target``.

    Row *i* of the extra rows varies seed *i mod n*, seeds in order of date. The
    extra rows are a range, so every seed gets the same number of them and the
    join that hands them out is balanced.
    """
    spark = real.sparkSession
    seeds = with_row_index(seeds, "seed_pos", "date_utc", "id")
    seed_count = seeds.agg(F.count("*")).scalar()
    real_count = real.agg(F.count("*")).scalar()
    extra = (
        spark.range(target)
        .where(F.col("id") < F.lit(target) - real_count)
        .select(
            F.col("id").alias("index"),
            F.try_mod("id", seed_count).alias("seed_pos"),
            (F.floor(F.try_divide("id", seed_count)) + 1).cast("int").alias("variant"),
        )
    )
    drawn = extra.join(_described(seeds, launchpads, rockets), "seed_pos")
    return real.unionByName(conform(_records(drawn), T.StructType.fromDDL(schemas.LAUNCH)))


def _described(seeds: DataFrame, launchpads: DataFrame, rockets: DataFrame) -> DataFrame:
    """Seeds with what is known of their pad and rocket."""
    pads = launchpad_coordinates(launchpads).select(
        F.col("id").alias("launchpad"),
        nonempty(F.col("name")).alias("pad_name"),
        nonempty(F.col("country_code")).alias("pad_country"),
        F.col("latitude").alias("pad_latitude"),
        F.col("longitude").alias("pad_longitude"),
    )
    vehicles = rockets.where(F.col("id").isNotNull()).select(
        F.col("id").alias("rocket"),
        nonempty(F.col("name")).alias("rocket_name"),
        nonempty(F.col("type")).alias("rocket_type"),
    )
    pictures = F.filter(
        F.concat(
            F.array("links.patch.small", "links.patch.large"),
            F.coalesce("links.flickr.original", F.array().cast("array<string>")),
        ),
        lambda url: nonempty(url).isNotNull(),
    )
    facts = seeds.select(
        "seed_pos",
        nonempty(F.col("id")).alias("seed_id"),
        F.coalesce(nonempty(F.col("name")), F.lit(K.SYNTHETIC_SEED_NAME)).alias("seed_name"),
        F.coalesce(instant(F.col("date_utc")), F.current_timestamp()).alias("seed_time"),
        "success",
        nonempty(F.col("launchpad")).alias("launchpad"),
        nonempty(F.col("rocket")).alias("rocket"),
        F.try_element_at(pictures, F.lit(1)).alias("image"),
        F.try_element_at(pictures, F.lit(2)).alias("infographic"),
    )
    return facts.join(pads, "launchpad", "left").join(vehicles, "rocket", "left")


def _records(drawn: DataFrame) -> DataFrame:
    """RAW launch records of drawn ``(index, variant, seed)`` rows."""
    index, variant = F.col("index"), F.col("variant")
    shift = F.make_dt_interval(
        days=(variant * 14 + index % 11).cast("int"), hours=(index % 24).cast("int")
    )
    no_place = F.col("pad_latitude").isNull() | F.col("pad_longitude").isNull()
    named = drawn.select(
        "*",
        F.coalesce("seed_id", F.concat(F.lit("seed-"), index.cast("string"))).alias("seed"),
        F.concat(
            "seed_name", F.lit(" Synthetic Batch "), F.format_string("%03d", variant)
        ).alias("name"),
        iso_utc(F.col("seed_time") + shift).alias("net"),
        F.coalesce("success", variant % 4 != 0).alias("succeeded"),
    ).withColumns(
        {
            "profile": mission_profile(F.col("name"), variant),
            "vehicle_key": F.coalesce("rocket", "seed"),
            "pad_key": F.coalesce("launchpad", "seed"),
            "site": F.coalesce("pad_name", F.lit(K.SYNTHETIC_PAD_NAME)),
            "country": F.coalesce("pad_country", F.lit(K.SYNTHETIC_PAD_COUNTRY)),
            "latitude": F.when(no_place, K.SYNTHETIC_PAD_LATITUDE).otherwise(F.col("pad_latitude")),
            "longitude": F.when(no_place, K.SYNTHETIC_PAD_LONGITUDE).otherwise(
                F.col("pad_longitude")
            ),
        }
    )
    return named.select(
        F.concat(
            F.lit("synthetic-"), "seed", F.lit("-"), F.format_string("%04d", variant)
        ).alias("id"),
        "name",
        "net",
        F.lit("launch").alias("type"),
        "image",
        "infographic",
        F.when(F.col("succeeded"), _status(K.SYNTHETIC_SUCCESS_STATUS))
        .otherwise(_status(K.SYNTHETIC_FAILURE_STATUS))
        .alias("status"),
        _struct(
            "launch_service_provider",
            id=F.lit(K.SYNTHETIC_PROVIDER_ID),
            name=F.lit(K.SYNTHETIC_PROVIDER_NAME),
        ),
        _struct(
            "rocket",
            id=_id(F.col("vehicle_key")),
            configuration=_struct(
                "configuration",
                id=_id(F.concat("vehicle_key", F.lit(":configuration"))),
                name=F.coalesce("rocket_name", "seed_name"),
                family=F.coalesce("rocket_type", "rocket_name", F.lit(K.SYNTHETIC_ROCKET_FAMILY)),
            ),
        ),
        _struct(
            "mission",
            id=_id(F.concat_ws(":", "seed", variant.cast("string"), F.lit("mission"))),
            name=F.col("name"),
            type=F.col("profile.type"),
            orbit=_struct("orbit", name=F.col("profile.orbit")),
        ),
        _struct(
            "pad",
            id=_id(F.col("pad_key")),
            name=F.col("site"),
            country_code=F.col("country"),
            latitude=F.col("latitude"),
            longitude=F.col("longitude"),
            location=_struct("location", name=F.col("site"), country_code=F.col("country")),
        ),
    )


def _id(key: Column) -> Column:
    return stable_int(key, K.SYNTHETIC_ID_MINIMUM, K.SYNTHETIC_ID_SPAN)


def _struct(name: str, /, **fields: Column) -> Column:
    return F.struct(*[value.alias(field) for field, value in fields.items()]).alias(name)


def _status(values: tuple[int, str, str]) -> Column:
    number, text, abbrev = values
    return _struct("status", id=F.lit(number), name=F.lit(text), abbrev=F.lit(abbrev))
