"""The batch job: RAW run to Silver, Silver to Gold."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger import constants as K
from skyledger.plans import gold, silver
from skyledger.sources import landing, schemas
from skyledger.sources.sinks import replace_partitions, write_parquet
from skyledger.sources.tables import read_table


def _silver_tables(scan: Callable[[str, str], DataFrame]) -> dict[str, DataFrame]:
    """The Silver tables that come straight from RAW, given how to scan a dataset."""
    return {
        "launches": silver.silver_launches(scan(K.LAUNCHES_FILE, schemas.LAUNCH)),
        "weather": silver.silver_weather(scan(K.WEATHER_FILE, schemas.WEATHER)),
        "spacex_rockets": silver.silver_rockets(scan(K.ROCKETS_FILE, schemas.ROCKET)),
        "images": silver.silver_images(
            scan(K.CATALOGUE_IMAGES_FILE, schemas.CATALOGUE_IMAGE),
            scan(K.VENDOR_IMAGES_FILE, schemas.VENDOR_IMAGE),
        ),
    }


PARTITIONS = {
    "launches": ["launch_year"],
    "weather": ["weather_year"],
    "spacex_rockets": None,
    "images": ["source", "launch_year"],
}


def read_silver(spark: SparkSession, silver_base: str, name: str) -> DataFrame:
    """One Silver table under the schema its transform gives it."""
    declared = _silver_tables(lambda _, schema: spark.createDataFrame([], schema))[name].schema
    return read_table(spark, f"{silver_base}/{name}", declared)


def run_silver(spark: SparkSession, raw_run: str, silver_base: str) -> None:
    """Normalise one RAW run into the five Silver tables."""

    def scan(file_name: str, schema: str) -> DataFrame:
        read = landing.read_documents if file_name == K.ROCKETS_FILE else landing.read_json
        return read(spark, f"{raw_run}/{file_name}", schema)

    for name, table in _silver_tables(scan).items():
        write_parquet(table, f"{silver_base}/{name}", PARTITIONS[name])
    costs = silver.silver_launch_costs(read_silver(spark, silver_base, "launches"))
    write_parquet(costs, f"{silver_base}/launch_costs", ["launch_year"])


def run_gold(spark: SparkSession, silver_base: str, gold_base: str) -> None:
    """Build both Gold tables from the written Silver tables, so that RAW JSON is
    parsed once and each scan reads only the columns it needs."""
    launches = read_silver(spark, silver_base, "launches")
    weather = read_silver(spark, silver_base, "weather")
    images = read_silver(spark, silver_base, "images")
    metrics = gold.company_year_metrics(launches)
    features = gold.launch_features(launches, weather, images)
    write_parquet(metrics, f"{gold_base}/company_year_metrics", ["launch_year"])
    write_parquet(features, f"{gold_base}/launch_features", ["launch_year"])


def update_gold(spark: SparkSession, silver_base: str, gold_base: str, years: DataFrame) -> None:
    """Bring both Gold tables up to date where Silver launches have changed.

    ``years`` has one row, with ``launch_year``, for each partition of Silver launches that
    was written since (as ``upsert`` tells). Only these are read and written again: both
    tables depend on the launches of a year alone, weather and images being looked up by
    launch. All other Gold files stay as they are.
    """
    # one row a partition: its values choose the folders to read
    launches = read_silver(spark, silver_base, "launches")
    changed = launches.join(F.broadcast(years.where("launch_year is not null")), "launch_year", "left_semi")
    if not years.where("launch_year is null").isEmpty():
        changed = changed.unionByName(launches.where("launch_year is null"))
    changed = changed.select(launches.columns)
    weather = read_silver(spark, silver_base, "weather")
    images = read_silver(spark, silver_base, "images")
    for name, table in (
        ("company_year_metrics", gold.company_year_metrics(changed)),
        ("launch_features", gold.launch_features(changed, weather, images)),
    ):
        replace_partitions(table, f"{gold_base}/{name}", "launch_year", years)


def run_job(
    spark: SparkSession, raw_base: str, silver_base: str, gold_base: str, run_id: str | None = None
) -> str:
    """Process the newest RAW run, or the one asked for; returns its id."""
    run = run_id or landing.newest_run_id(spark, raw_base)
    run_silver(spark, f"{raw_base}/{run}", silver_base)
    run_gold(spark, silver_base, gold_base)
    return run
