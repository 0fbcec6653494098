"""Edge rows of the RAW layer, with expected values worked out by hand."""

from __future__ import annotations

import datetime
import json

import pytest

from skyledger import constants as K
from skyledger.plans import gold, job, launch_frame, rockets, silver, status
from skyledger.sources import landing, schemas, tables


def records(spark, schema, *rows):
    """Rows as JSON text parsed under a declared schema, as a landing is."""
    lines = [(json.dumps(row),) for row in rows]
    parsed = spark.createDataFrame(lines, "line STRING").selectExpr(
        f"from_json(line, '{' '.join(schema.split())}') AS r"
    )
    return parsed.select("r.*")


def launch(id_="a", abbrev="Success", **fields):
    base = {"id": id_, "name": "N", "net": "2020-01-02T03:04:05Z", "status": {"abbrev": abbrev}}
    return {**base, **fields}


def by_id(df, column):
    return {row["launch_id"]: row[column] for row in df.collect()}


def test_launch_without_id_is_dropped(spark):
    raw = records(spark, schemas.LAUNCH, launch("a"), launch(None))
    assert by_id(silver.silver_launches(raw), "launch_year") == {"a": 2020}


@pytest.mark.parametrize(
    "abbrev, lenient, strict",
    [
        ("Success", 1, 1),
        ("Failure", 0, 0),
        ("Failed", 0, 0),
        ("Partial Failure", 0, None),
        ("Partial Success", 1, None),
        ("TBD", 0, None),
        (None, 0, None),
    ],
)
def test_two_success_definitions(spark, abbrev, lenient, strict):
    raw = records(spark, schemas.LAUNCH_WIDE, launch("a", abbrev))
    assert silver.silver_launches(raw).first()["is_success"] == lenient
    assert launch_frame.launch_frame(raw).first()["is_success"] == strict


def test_missing_parents_give_nulls_and_keep_the_row(spark):
    row = launch("a", mission=None, pad={"latitude": "28.5"})
    out = silver.silver_launches(records(spark, schemas.LAUNCH, row)).first()
    assert (out["mission_name"], out["location_name"], out["pad_latitude"]) == (None, None, 28.5)


def test_coordinates_as_text_or_number(spark):
    rows = [launch("a", pad={"latitude": "28.5"}), launch("b", pad={"latitude": 28.5}),
            launch("c", pad={"latitude": "north"})]
    out = by_id(silver.silver_launches(records(spark, schemas.LAUNCH, *rows)), "pad_latitude")
    assert out == {"a": 28.5, "b": 28.5, "c": None}


def test_unreadable_net_keeps_the_row(spark):
    out = silver.silver_launches(records(spark, schemas.LAUNCH, launch("a", net="soon"))).first()
    assert (out["launch_ts"], out["launch_date"], out["launch_year"]) == (None, None, None)


def test_net_with_offset_is_read_in_utc(spark):
    raw = records(spark, schemas.LAUNCH, launch("a", net="2024-05-01T23:30:00-05:00"))
    assert silver.silver_launches(raw).first()["launch_date"] == datetime.date(2024, 5, 2)


def test_weather_series_empty_missing_or_present(spark):
    def sample(id_, **daily):
        return {"launch_id": id_, "date": "2020-01-02", "weather": {"daily": daily}}

    raw = records(
        spark,
        schemas.WEATHER,
        sample("a", temperature_2m_mean=[1.5, 9.0]),
        sample("b", temperature_2m_mean=[]),
        sample("c"),
        {"launch_id": "d"},
        {"date": "2020-01-02"},
    )
    out = by_id(silver.silver_weather(raw), "temperature_2m_mean")
    assert out == {"a": 1.5, "b": None, "c": None, "d": None}


def test_catalogue_images_deduplicate_in_silver_only(spark):
    def record(id_, image, infographic):
        net = "2020-01-02T00:00:00Z"
        return {"launch_library_id": id_, "name": "n", "net": net, "image": image,
                "infographic": infographic}

    catalogue = records(
        spark,
        schemas.CATALOGUE_IMAGE,
        record("same", "u", "u"),
        record("one", None, "u"),
        record("none", None, None),
        record("two", "u", "v"),
    )
    vendor = records(
        spark,
        schemas.VENDOR_IMAGE,
        {"spacex_launch_id": "v", "name": "n", "date_utc": "2021-01-02", "image_urls": ["p", "p", None]},
        {"spacex_launch_id": "e", "name": "n", "date_utc": "2021-01-02", "image_urls": []},
        {"spacex_launch_id": "m", "name": "n", "date_utc": "2021-01-02"},
    )
    images = silver.silver_images(catalogue, vendor)
    counts = {(r["source"], r["launch_id"]): r["image_count"] for r in gold.image_counts(images).collect()}
    assert counts == {
        (K.CATALOGUE_SOURCE, "same"): 1,
        (K.CATALOGUE_SOURCE, "one"): 1,
        (K.CATALOGUE_SOURCE, "two"): 2,
        (K.VENDOR_SOURCE, "v"): 2,
    }
    assert launch_frame.images_from_raw(catalogue, vendor).count() == 2 + 1 + 2 + 2


def test_costs_of_known_unknown_and_missing_rockets(spark):
    def on(id_, name):
        return launch(id_, rocket={"configuration": {"name": name}})

    raw = records(spark, schemas.LAUNCH, on("a", "Electron"), on("b", "Kite"), on("c", None))
    rows = silver.silver_launch_costs(silver.silver_launches(raw)).collect()
    costs = {r["launch_id"]: (r["estimated_cost_usd"], r["cost_per_kg_leo_usd"], r["cost_category"])
             for r in rows}
    assert costs == {
        "a": (7_500_000, 35_714, "Budget"),
        "b": (50_000_000, 5_000, "Standard"),
        "c": (50_000_000, 5_000, "Standard"),
    }


def test_metrics_keep_null_groups_and_features_fan_out(spark):
    raw = records(
        spark,
        schemas.LAUNCH,
        launch("a", launch_service_provider={"name": "P"}),
        launch("b", net="soon"),
        launch("c", "Failure", launch_service_provider={"name": "P"}),
    )
    launches = silver.silver_launches(raw)
    metrics = {(r["launch_year"], r["provider_name"]): (r["total_launches"], r["success_rate_pct"])
               for r in gold.company_year_metrics(launches).collect()}
    assert metrics == {(2020, "P"): (2, 50.0), (None, None): (1, 100.0)}

    weather = spark.createDataFrame(
        [("a", 1.0, 2.0), ("a", 3.0, 4.0)],
        "launch_id STRING, temperature_2m_mean DOUBLE, wind_speed_10m_max DOUBLE",
    )
    images = spark.createDataFrame(
        [(K.CATALOGUE_SOURCE, "a", "u"), (K.VENDOR_SOURCE, "c", "u")],
        "source STRING, launch_id STRING, image_url STRING",
    )
    features = gold.launch_features(launches, weather, images)
    rows = sorted((r["launch_id"], r["temperature_2m_mean"], r["launch_image_count"])
                  for r in features.where("launch_id = 'a'").collect())
    assert rows == [("a", 1.0, 1), ("a", 3.0, 1)]
    assert {r["launch_id"]: r["launch_image_count"] for r in features.collect()} == {"a": 1, "b": 0, "c": 0}


def test_compaction_adds_missing_parents(spark):
    wide = records(spark, schemas.LAUNCH_WIDE, {"id": "a", "name": "n"})
    row = launch_frame.compact_launches(wide).first()
    assert row["mission"] is not None and row["mission"]["orbit"]["name"] is None
    assert "abbrev" not in row["mission"]["orbit"].asDict()


def test_orbit_falls_back_and_provider_type_defaults(spark):
    rows = [
        launch("a", mission={"orbit": {"name": "", "abbrev": "LEO"}}),
        launch("b", mission={"orbit": {"name": "Low", "abbrev": "LEO"}},
               launch_service_provider={"type": "Gov"}),
    ]
    out = launch_frame.launch_frame(records(spark, schemas.LAUNCH_WIDE, *rows)).collect()
    seen = {r["launch_id"]: (r["mission_orbit"], r["provider_type"]) for r in out}
    assert seen == {"a": ("LEO", "Unknown"), "b": ("Low", "Gov")}


def test_launch_images_in_order_without_empty_launches(spark):
    def links(small, large, original):
        return {"patch": {"small": small, "large": large}, "flickr": {"original": original}}

    raw = records(
        spark,
        schemas.VENDOR_LAUNCH,
        {"id": "a", "links": links("s", "", ["p", "q"])},
        {"id": "b", "links": links(None, None, [])},
        {"id": "c"},
        {"id": "d", "links": links(None, "l", None)},
    )
    out = {r["spacex_launch_id"]: r["image_urls"] for r in launch_frame.extract_launch_images(raw).collect()}
    assert out == {"a": ["s", "p", "q"], "d": ["l"]}


def test_weather_targets_keep_the_stated_date(spark):
    launches = spark.createDataFrame(
        [
            ("a", "2024-05-01T23:30:00-05:00", (1.0, 2.0)),
            ("b", "soon", (1.0, 2.0)),
            ("c", "2024-05-03T00:00:00Z", (None, 2.0)),
            ("d", None, (1.0, 2.0)),
            ("e", "2024-05-02T00:00:00Z", (0.0, 0.0)),
        ],
        "id STRING, net STRING, pad STRUCT<latitude: DOUBLE, longitude: DOUBLE>",
    )
    targets = launch_frame.weather_targets(launches)
    assert sorted((r["launch_id"], r["date"]) for r in targets.collect()) == [
        ("a", "2024-05-01"),
        ("e", "2024-05-02"),
    ]
    assert launch_frame.weather_targets(launches, max_samples=1).count() == 1


def test_landing_tolerates_bad_lines_and_missing_files(spark, tmp_path):
    run = tmp_path / "20240101_000000"
    run.mkdir()
    lines = [json.dumps(launch("a")), "", "{broken", json.dumps(launch("b"))]
    (run / K.LAUNCHES_FILE).write_text("\n".join(lines))
    path = f"{run}/{K.LAUNCHES_FILE}"
    assert silver.silver_launches(landing.read_launches(spark, path)).count() == 2
    frame = launch_frame.launch_frame(landing.read_launches(spark, path, strict=True))
    assert sorted(r["launch_id"] for r in frame.collect()) == ["a", "b"]
    empty = landing.read_json(spark, f"{run}/{K.WEATHER_FILE}", schemas.WEATHER)
    assert empty.count() == 0 and silver.silver_weather(empty).columns[0] == "launch_id"
    (run / K.WEATHER_FILE).write_text("")
    assert landing.read_json(spark, f"{run}/{K.WEATHER_FILE}", schemas.WEATHER).count() == 0


def test_job_processes_the_newest_run(spark, tmp_path):
    rocket = {"id": "r", "name": "Electron", "height": {"meters": 18}, "flickr_images": ["f"]}
    for run, ids in (("20240101_000000", ["old"]), ("20240102_000000", ["a", "b"])):
        folder = tmp_path / "raw" / run
        folder.mkdir(parents=True)
        (folder / K.LAUNCHES_FILE).write_text("\n".join(json.dumps(launch(i)) for i in ids))
        (folder / K.ROCKETS_FILE).write_text(json.dumps([rocket], indent=2))
    base = str(tmp_path)
    run = job.run_job(spark, f"{base}/raw", f"{base}/silver", f"{base}/gold")
    assert run == "20240102_000000"
    features = tables.load_features(tables.read_table(spark, f"{base}/gold/launch_features"))
    assert sorted(r["launch_id"] for r in features.collect()) == ["a", "b"]
    rockets = tables.read_table(spark, f"{base}/silver/spacex_rockets").collect()
    assert [(r["rocket_name"], r["height_meters"]) for r in rockets] == [("Electron", 18.0)]
    runs = landing.read_runs(spark, f"{base}/raw", K.LAUNCHES_FILE, schemas.LAUNCH)
    assert {(r["run_id"], r["id"]) for r in runs.collect()} == {
        ("20240101_000000", "old"),
        ("20240102_000000", "a"),
        ("20240102_000000", "b"),
    }
    job.run_job(spark, f"{base}/raw", f"{base}/silver", f"{base}/gold", run_id="20240101_000000")
    again = tables.read_table(spark, f"{base}/gold/launch_features")
    assert [r["launch_id"] for r in again.collect()] == ["old"]


@pytest.mark.parametrize("indent", [None, 2])
def test_rockets_as_array_or_lines(spark, tmp_path, indent):
    data = [{"id": "1", "name": "A", "flickr_images": ["x", "y"]}, {"id": "2", "name": "B", "stages": 2}]
    (tmp_path / "array.json").write_text(json.dumps(data, indent=indent))
    lines = tmp_path / "lines.json"
    lines.mkdir()
    (lines / "part-0.json").write_text("\n".join(json.dumps(r) for r in data) + "\n")
    for path in ("array.json", "lines.json"):
        raw = landing.read_rockets(spark, f"{tmp_path}/{path}")
        assert sorted((r["id"], r["name"], r["stages"]) for r in raw.collect()) == [("1", "A", None), ("2", "B", 2)]
        picture = rockets.rocket_first_image(raw, "A").collect()
        assert [r["image_url"] for r in picture] == ["x"]
    assert landing.read_rockets(spark, f"{tmp_path}/none.json").count() == 0


def test_landed_run_has_a_manifest(spark, tmp_path):
    datasets = {"a.jsonl": spark.range(3), "b.jsonl": spark.range(0)}
    run = status.land_run(spark, str(tmp_path), datasets, {"pages": 5})
    manifest = spark.read.schema("files MAP<STRING, BIGINT>, config STRUCT<pages: INT>").json(
        f"{tmp_path}/{run}/{K.MANIFEST_FILE}"
    )
    row = manifest.first()
    assert row["files"] == {"a.jsonl": 3, "b.jsonl": 0} and row["config"]["pages"] == 5
    assert landing.newest_run_id(spark, str(tmp_path)) == run


def test_unreadable_files_can_be_skipped(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).coalesce(1).write.parquet(path)
    (tmp_path / "t" / "broken.parquet").write_text("not parquet at all")
    assert tables.read_table(spark, path, "id BIGINT", skip_corrupt=True).count() == 3
