"""Buckets grow with the tables, and images are read once for the features."""

from __future__ import annotations

import contextlib
import io
import os

from skyledger.bindings import upkeep
from skyledger.plans import gold

LAUNCH = """launch_id STRING, launch_name STRING, launch_date DATE, launch_year INT, provider_name STRING,
rocket_name STRING, mission_type STRING, mission_orbit STRING, pad_country_code STRING, pad_latitude DOUBLE,
pad_longitude DOUBLE, is_success INT"""


def test_buckets_grow_with_the_tables(spark, sf_dir, monkeypatch):
    stored = sum(os.path.getsize(f"{sf_dir}/{name}.parquet") for name in ("orders", "lineitem", "events"))
    assert upkeep.buckets_of(spark, sf_dir) == upkeep.BUCKETS
    monkeypatch.setattr(upkeep, "BUCKET_BYTES", stored // 40)
    assert upkeep.buckets_of(spark, sf_dir) in (40, 41)
    monkeypatch.setattr(upkeep, "MOST_BUCKETS", 30)
    assert upkeep.buckets_of(spark, sf_dir) == 30


def test_images_are_read_once_and_launches_without_an_id_stay(spark, tmp_path):
    rows = [(i, f"n{i}") + (None,) * 10 for i in ("a", "b", None, None)]
    weather = spark.createDataFrame([("a", 1.0, 2.0), (None, 3.0, 4.0)], "launch_id STRING, temperature_2m_mean DOUBLE, wind_speed_10m_max DOUBLE")
    pictures = [("launch_library", "a", "x"), ("launch_library", "a", "y"), ("launch_library", None, "z")]
    spark.createDataFrame(pictures, "source STRING, launch_id STRING, image_url STRING").write.parquet(f"{tmp_path}/images")
    images = spark.read.parquet(f"{tmp_path}/images")
    spark.createDataFrame(rows, LAUNCH).write.parquet(f"{tmp_path}/launches")
    out = gold.launch_features(spark.read.parquet(f"{tmp_path}/launches"), weather, images)
    got = out.select("launch_id", "temperature_2m_mean", "wind_speed_10m_max", "launch_image_count").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [("a", 1.0, 2.0, 2), ("b", None, None, 0), (None, None, None, 0), (None, None, None, 0)], key=str
    )
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        out.explain("formatted")
    # once for usual and once for hot launches, not for those without an id
    read = shown.getvalue().split("== Initial Plan ==")[-1]
    assert sum(line.startswith("Location:") and line.rstrip("]").endswith("/images") for line in read.splitlines()) == 2
