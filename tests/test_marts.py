"""Mart rules that the driver's tables do not reach, and invariants."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from skyledger.bindings.catalogue import Tables
from skyledger.plans import (
    context,
    costs,
    explorer,
    gallery,
    geography,
    history,
    overview,
    providers,
    rockets,
    status,
    synthetic,
    weather,
)
from skyledger.sources import schemas

METRICS = "launch_year INT, provider_name STRING, total_launches BIGINT, successful_launches BIGINT, success_rate_pct DOUBLE"


def metrics_of(spark, *rows):
    full = [(y, p, t, s, round(100 * s / t, 2) if t else None) for y, p, t, s in rows]
    return spark.createDataFrame(full, METRICS)


def test_rolling_mean_spans_rows_not_years(spark):
    years = [2000, 2001, 2002, 2003, 2004, 2010]
    metrics = metrics_of(spark, *[(y, "P", 10, i) for i, y in enumerate(years)])
    rows = {r["year"]: r for r in history.yearly_activity(metrics).collect()}
    assert rows[2010]["rolling"] == pytest.approx((10 + 20 + 30 + 40 + 50) / 5)
    assert rows[2000]["rolling"] == 0.0
    assert rows[2010]["cumulative"] == 60 and rows[2010]["cum_success"] == 15
    assert rows[2004]["failed"] == 6


def test_a_year_of_zero_launches_has_no_rate(spark):
    rows = history.yearly_activity(metrics_of(spark, (2000, "P", 0, 0), (2001, "P", 4, 1))).collect()
    assert [(r["rate"], r["rolling"]) for r in rows] == [(None, None), (25.0, 25.0)]


def test_null_providers_count_in_years_but_not_in_rankings(spark):
    metrics = metrics_of(spark, (2000, None, 5, 5), (2000, "P", 1, 0))
    assert history.yearly_activity(metrics).first()["total"] == 6
    assert [r["provider_name"] for r in providers.provider_stats(metrics).collect()] == ["P"]


def test_race_fills_missing_years_and_keeps_ranking_order_on_ties(spark):
    metrics = metrics_of(spark, (2000, "A", 2, 0), (2000, "B", 2, 0), (2001, "C", 1, 0), (2002, "B", 3, 0))
    rows = providers.race_cumulative(metrics).collect()
    table = {(r["year"], r["provider"]): (r["running"], r["position"]) for r in rows}
    assert table[(2001, "A")] == (2, 3) and table[(2001, "B")] == (2, 2) and table[(2001, "C")] == (1, 1)
    assert table[(2000, "C")] == (0, 1) and table[(2002, "B")] == (5, 3)
    assert len(rows) == 9


def test_empty_tables_give_defaults(spark):
    empty = spark.createDataFrame([], METRICS)
    hero = overview.hero_summary(empty, 2000, 2004).first()
    assert (hero["total"], hero["rate"], hero["years"], hero["providers"]) == (0, 0.0, 5, 0)
    pages = gallery.gallery_pages(spark.createDataFrame([], "launch_id STRING")).first()
    assert (pages["total"], pages["pages"]) == (0, 1)


@pytest.mark.parametrize("rows, pages", [(20, 1), (21, 2), (40, 2), (41, 3)])
def test_page_count(spark, rows, pages):
    assert gallery.gallery_pages(spark.range(rows)).first()["pages"] == pages


def images(spark, n=47):
    rows = [("s" if i % 2 else "t_x", f"id{i % 9}", f"Falcon [{i}]" if i % 5 else None, 2000 + i % 3, f"u{i}")
            for i in range(n)]
    return spark.createDataFrame(
        rows, "source STRING, launch_id STRING, launch_name STRING, launch_year INT, image_url STRING")


def test_pages_cover_the_search_exactly_once(spark):
    found = gallery.gallery_search(images(spark), pattern=r"FALCON \[\d+\]")
    total = found.count()
    assert total == 37
    paged = [r for p in range(3) for r in gallery.gallery_page(found, p).collect()]
    assert sorted(r["image_url"] for r in paged) == sorted(r["image_url"] for r in found.collect())
    assert gallery.gallery_page(found, 9).count() == 0


def test_reading_on_after_a_card_keeps_repeated_images(spark):
    found = images(spark, 30).unionByName(images(spark, 30)).unionByName(images(spark, 7))
    expected = [r["image_url"] for p in range(4) for r in gallery.gallery_page(found, p).collect()]
    assert len(expected) == 67
    ordered = sorted(
        ((r["launch_year"], r["source"], r["launch_id"], r["image_url"], r["launch_name"] or "")
         for r in found.collect()))
    for shown in (1, 20, 33, 66):
        last = ordered[shown - 1]
        page = gallery.gallery_after(found, last, shown_alike=ordered[:shown].count(last)).collect()
        assert [r["image_url"] for r in page] == expected[shown : shown + 20]


def test_gallery_filters_and_cards(spark):
    df = images(spark, 6)
    assert {r["source"] for r in gallery.gallery_search(df, source="t_x").collect()} == {"t_x"}
    assert gallery.gallery_search(df, year=2001).count() == 2
    assert gallery.gallery_search(df, pattern="falcon").count() == 4
    cards = {r["image_url"]: r for r in gallery.gallery_page(df, 0).collect()}
    assert cards["u0"]["caption"] == "— · 2000" and cards["u0"]["source_label"] == "T X"


def test_box_whiskers_and_outliers(spark):
    rows = [(str(i), 1, float(i), 5.0) for i in range(1, 12)] + [("x", 1, 100.0, 5.0), ("n", None, 3.0, 5.0)]
    features = spark.createDataFrame(
        rows, "launch_id STRING, is_success INT, temperature_2m_mean DOUBLE, wind_speed_10m_max DOUBLE")
    boxes = {(r["measure"], r["outcome"]): r for r in weather.weather_box_stats(features).collect()}
    box = boxes[(weather.TEMPERATURE, "Éxito")]
    assert (box["total"], box["q1"], box["median"], box["q3"]) == (12, 3.75, 6.5, 9.25)
    assert (box["whisker_low"], box["whisker_high"], box["outliers"]) == (1.0, 11.0, 1)
    assert boxes[(weather.TEMPERATURE, "Desconocido")]["total"] == 1
    points = weather.weather_outliers(features).collect()
    assert [(p["launch_id"], p["reading"]) for p in points] == [("x", 100.0)]


def test_histogram_of_one_value_is_one_bin(spark):
    features = spark.createDataFrame(
        [("a", 1, 4.0, 1.0), ("b", 1, 4.0, 1.0)],
        "launch_id STRING, is_success INT, temperature_2m_mean DOUBLE, wind_speed_10m_max DOUBLE")
    assert [(r["bin"], r["launches"]) for r in weather.temp_histogram(features).collect()] == [(1, 2)]


ROCKETS = """spacex_rocket_id STRING, rocket_name STRING, is_active BOOLEAN, stages INT, boosters INT,
cost_per_launch_usd BIGINT, success_rate_pct DOUBLE, first_flight_date STRING, height_meters DOUBLE,
diameter_meters DOUBLE, mass_kg DOUBLE, description STRING"""


def test_rocket_defaults(spark):
    df = spark.createDataFrame(
        [("1", "Big", None, 0, 0, None, None, None, 240.0, 9.0, 5e6, "d" * 301),
         ("2", "Unknown", True, 2, 0, 25_000_000, 98.0, "2010", None, 3.0, 549_054.0, "")],
        ROCKETS)
    radar = rockets.rocket_radar(df).collect()
    assert [(r["name"], r["h"], r["m"], r["sr"], r["stage"]) for r in radar] == [("Big", 1.0, 1.0, 0.0, 1 / 3)]
    assert radar[0]["eco"] == pytest.approx(1 - 1e-8)
    specs = {r["Cohete"]: r for r in rockets.rocket_specs(df).collect()}
    assert specs["Big"]["Costo ($)"] == "—" and specs["Unknown"]["Masa (kg)"] == "549,054"
    lines = {(r["rocket_name"], r["step"]): r["line"] for r in context.context_rockets(df).collect()}
    assert lines[("Big", 1)] == "- Estado: Inactivo | Coste: N/D | Éxito: N/D | Altura: 240m | Masa: 5000t | Primer vuelo: N/D"
    assert lines[("Big", 2)] == "- " + "d" * 300 + "..."
    assert ("Unknown", 2) not in lines
    card = {r["rocket_name"]: r["description"] for r in rockets.rocket_cards(df).collect()}
    assert card["Big"] == "d" * 240 + "…"


def test_unknown_rockets_use_the_default_rate(spark):
    known = spark.createDataFrame([("1", "A", 50.0), ("2", "A", 90.0), ("3", "B", None)],
                                  "spacex_rocket_id STRING, rocket_name STRING, success_rate_pct DOUBLE")
    launches = spark.createDataFrame(
        [("x", "A", 20.0, 10.0), ("y", "B", 20.0, 10.0), ("z", "C", 20.0, None)],
        "launch_id STRING, rocket_name STRING, temperature_2m_mean DOUBLE, wind_speed_10m_max DOUBLE")
    rows = {r["launch_id"]: r for r in rockets.launch_probability(launches, known).collect()}
    assert (rows["x"]["base"], rows["y"]["base"], rows["z"]["base"]) == (0.5, 0.82, 0.82)
    assert rows["y"]["probability_pct"] == 82.0 and rows["y"]["band"].startswith("Condiciones óptimas")
    assert rows["z"]["probability"] is None and rows["z"]["band"] is None


def synthetic_inputs(spark):
    real = spark.createDataFrame([], schemas.LAUNCH).unionByName(
        spark.createDataFrame([("r1",)], "id STRING"), allowMissingColumns=True)
    seeds = spark.createDataFrame(
        [("s2", "Starlink", "2020-01-02T00:00:00.000Z", None, "k", "p"),
         ("s1", None, "2020-01-01T00:00:00.500Z", True, "", None)],
        "id STRING, name STRING, date_utc STRING, success BOOLEAN, rocket STRING, launchpad STRING",
    ).withColumn("links", F.lit(None).cast(
        "STRUCT<patch: STRUCT<small: STRING, large: STRING>, flickr: STRUCT<original: ARRAY<STRING>>>"))
    pads = spark.createDataFrame([("p", "Pad", None, 1.0, None, None, None)], schemas.LAUNCHPAD)
    vehicles = spark.createDataFrame([("k", "Kite", None)], "id STRING, name STRING, type STRING")
    return real, seeds, pads, vehicles


def test_synthetic_rows_cycle_through_seeds(spark):
    real, seeds, pads, vehicles = synthetic_inputs(spark)
    out = synthetic.synthetic_expand(real, seeds, pads, vehicles, target=6).collect()
    rows = {r["id"]: r for r in out}
    assert sorted(rows) == ["r1", "synthetic-s1-0001", "synthetic-s1-0002", "synthetic-s1-0003",
                            "synthetic-s2-0001", "synthetic-s2-0002"]
    first = rows["synthetic-s1-0001"]  # index 0, variant 1: 14 days later
    assert first["name"] == "Synthetic Launch Synthetic Batch 001"
    assert first["net"] == "2020-01-15T00:00:00.500000Z" and first["status"]["abbrev"] == "Success"
    assert first["rocket"]["configuration"]["name"] == "Synthetic Launch"
    assert first["rocket"]["configuration"]["family"] == "Falcon"
    second = rows["synthetic-s2-0001"]  # index 1: 14 + 1 days and 1 hour later
    assert second["net"] == "2020-01-17T01:00:00Z" and second["mission"]["orbit"]["name"] == "LEO"
    assert second["rocket"]["configuration"]["family"] == "Kite"
    assert second["pad"]["name"] == "Pad" and second["pad"]["country_code"] == "US"
    assert (second["pad"]["latitude"], second["pad"]["longitude"]) == ("25.997", "-97.155")
    assert second["status"]["id"] == 3  # variant 1: 1 % 4 != 0


def test_no_synthetic_rows_when_not_needed_or_without_seeds(spark):
    real, seeds, pads, vehicles = synthetic_inputs(spark)
    for chosen, target in ((seeds, 1), (seeds, 0), (seeds.limit(0), 9)):
        out = synthetic.synthetic_expand(real, chosen, pads, vehicles, target)
        assert [r["id"] for r in out.collect()] == ["r1"]


def test_status_reports(spark):
    landed = spark.createDataFrame(
        [(f"run{i}", "launches") for i in range(7)] + [("run6", "weather")], "run_id STRING, dataset STRING")
    rows = {(r["run_id"], r["dataset"]): r["rows"] for r in status.data_status(landed, ["launches", "weather"]).collect()}
    assert len(rows) == 10 and rows[("run6", "weather")] == 1 and rows[("run2", "weather")] == 0
    manifest = status.run_manifest({"a": landed, "b": landed.limit(0)})
    document = status.manifest_document(manifest, {"pages": 5, "batch": True}, "2024-01-01T00:00:00+00:00").first()
    assert document["files"] == {"a": 8, "b": 0}
    assert document["config"]["pages"] == 5 and document["config"]["batch"] is True


def test_context_document_as_text(spark, tmp_path):
    metrics = metrics_of(spark, (2000, "P", 1200, 900), (2001, "Q", 3, 1))
    costs_df = spark.createDataFrame(
        [("P", "Electron", "Budget", 7_500_000), ("Q", None, "Standard", 50_000_000)],
        "provider_name STRING, rocket_name STRING, cost_category STRING, estimated_cost_usd BIGINT")
    launches = spark.createDataFrame(
        [("Test", "LEO", "US", "Electron"), ("Test", None, "US", None)],
        "mission_type STRING, mission_orbit STRING, pad_country_code STRING, rocket_name STRING")
    rocket = spark.createDataFrame([("1", "Kite", True, 2, 0, 6_500_000, 98.0, "2010", 70.0, 3.7, 549_054.0, "Flies.")], ROCKETS)
    path = str(tmp_path / "report")
    context.write_document(context.context_document(metrics, costs_df, launches, rocket), path)
    text = "\n".join(r["value"] for r in spark.read.text(path).coalesce(1).collect())
    assert text.splitlines() == [
        "# Datos del Dashboard",
        "",
        "## Resumen general",
        "- Periodo: 2000–2001",
        "- Total lanzamientos: 1,203",
        "- Exitosos: 901 (74.9%)",
        "",
        "## Top 10 proveedores",
        "- P: 1200 lanzamientos, tasa éxito 75.0%",
        "- Q: 3 lanzamientos, tasa éxito 33.3%",
        "",
        "## Costes de lanzamiento (estimados)",
        "- Inversión total: $0.1B USD",
        "- Coste promedio: $28.8M USD/lanzamiento",
        "- Categorías: Budget=1, Standard=1",
        "- Coste medio por proveedor:",
        "  - Q: $50.0M",
        "  - P: $7.5M",
        "- Cohetes más caros:",
        "  - Electron: $7.5M",
        "",
        "## Tipos de misión",
        "- Test: 2",
        "",
        "## Órbitas",
        "- LEO: 1",
        "",
        "## Países con más lanzamientos",
        "- US: 2",
        "",
        "## Cohetes más usados",
        "- Electron: 1 lanzamientos",
        "",
        "## Cohetes SpaceX (API oficial)",
        "### Kite",
        "- Estado: Activo | Coste: $6M | Éxito: 98% | Altura: 70m | Masa: 549t | Primer vuelo: 2010",
        "- Flies.",
    ]


def test_invariants(spark, sf_dir):
    t = Tables(spark, sf_dir)
    gold = t.gold_metrics.agg(
        F.sum("total_launches").alias("n"), F.max(F.col("successful_launches") > F.col("total_launches")).alias("bad")
    ).first()
    assert gold["n"] == t.launches.count() and gold["bad"] is False
    share = providers.market_share(t.metrics).agg(F.sum("share")).first()[0]
    assert math.isclose(share, 1.0)
    race = providers.race_cumulative(t.metrics)
    final = {r["provider"]: r["running"] for r in race.where("year = 2001").collect()}
    totals = {r["provider_name"]: r["total"] for r in providers.provider_stats(t.metrics).collect()}
    assert final and all(totals[p] == n for p, n in final.items())
    pads = geography.pad_stats(t.frame).agg(F.sum("total"), F.max("dot_size"), F.min("dot_size")).first()
    assert pads[0] == t.frame.count() and pads[1] == 25.0 and pads[2] >= 5.0
    years = [r["Año"] for r in explorer.launch_explorer(t.features).collect()]
    assert years == sorted(years, reverse=True)


def test_cost_sums_do_not_overflow(spark):
    big = 4_000_000_000_000_000_000
    df = spark.createDataFrame([("P", 2000, 1, big)] * 4,
                               "provider_name STRING, launch_year INT, is_success INT, estimated_cost_usd BIGINT")
    row = costs.cost_kpis(df).first()
    assert row["total_cost"] == 1.6e19 and row["mean_cost"] == float(big)
