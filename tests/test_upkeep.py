"""Tables kept up run by run: cursor, merge, partial rebuilds, pruning, layouts, footers."""

from __future__ import annotations

import contextlib
import io
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from skyledger.bindings import upkeep
from skyledger.operators.filters import global_filter
from skyledger.operators.running import with_running_total
from skyledger.plans import gallery, gold, history, job, silver, status
from skyledger.session import new_workspace
from skyledger.sources import landing, schemas, sinks, tables
from skyledger.streaming import cursor
from skyledger.streaming.upsert import accumulate_runs, upsert


def plan_of(df, mode="formatted"):
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        df.explain(mode)
    return shown.getvalue()


def stamps(folder, *skip):
    """Every file but those of some partitions, and when it was written."""
    return {
        str(f): f.stat().st_mtime_ns for f in Path(folder).rglob("part-*.parquet") if not any(s in str(f) for s in skip)
    }


# --- Cursor


def put_pages(base, names):
    for name in names:
        folder = base / "in" / f"page={name}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / "rows.json").write_text(json.dumps({"id": f"{name}!"}) + "\n")


def take(spark, base, run, **how):
    entry = cursor.take_pages(spark, f"{base}/in", "id STRING", f"{base}/out", f"{base}/log", run, **how)
    return entry["first_page"], entry["last_page"], entry["pages"], entry["cursor"]


def taken(spark, base):
    rows = cursor.taken_rows(spark, f"{base}/out", f"{base}/log", "id STRING")
    return sorted((r["run_id"], r["page"], r["id"]) for r in rows.collect())


def test_cursor_moves_by_its_budget_wraps_and_resets(spark, tmp_path):
    put_pages(tmp_path, ["a", "b", "c", "d", "e"])
    assert take(spark, tmp_path, "r1", budget=2) == ("a", "b", 2, "b")
    assert take(spark, tmp_path, "r2", budget=2) == ("c", "d", 2, "d")
    assert take(spark, tmp_path, "r3", budget=2) == ("e", "e", 1, None)
    assert take(spark, tmp_path, "r4", budget=2) == ("a", "b", 2, "b")
    put_pages(tmp_path, ["bb", "f"])
    assert take(spark, tmp_path, "r5", budget=2) == ("bb", "c", 2, "c")
    assert take(spark, tmp_path, "r6", budget=3, reset=True) == ("a", "bb", 3, "bb")
    assert take(spark, tmp_path, "r7") == ("c", "f", 4, None)
    want = [("r1", "ab"), ("r2", "cd"), ("r3", "e"), ("r4", "ab"), ("r7", "cdef")]
    assert [t for t in taken(spark, tmp_path) if t[0] in dict(want)] == [(r, p, f"{p}!") for r, ps in want for p in ps]


def test_run_repeated_after_a_failure_adds_nothing(spark, tmp_path, monkeypatch):
    put_pages(tmp_path, ["a", "b", "c"])
    take(spark, tmp_path, "r1", budget=1)
    before = taken(spark, tmp_path)

    def broken(*_):
        raise OSError("between data and log")

    with monkeypatch.context() as patch:
        patch.setattr(cursor, "Row", broken)
        patch.setattr(spark, "createDataFrame", broken)
        with pytest.raises(OSError):
            take(spark, tmp_path, "r2", budget=1)
    assert (tmp_path / "out" / "run_id=r2").exists()
    assert taken(spark, tmp_path) == before
    assert take(spark, tmp_path, "r3", budget=1) == ("b", "b", 1, "b")
    assert take(spark, tmp_path, "r2", budget=1) == ("c", "c", 1, None)
    assert take(spark, tmp_path, "r2", budget=1) == ("c", "c", 1, None)
    assert taken(spark, tmp_path) == [("r1", "a", "a!"), ("r2", "c", "c!"), ("r3", "b", "b!")]


def test_cursor_without_pages(spark, tmp_path):
    assert take(spark, tmp_path, "r1", budget=2) == (None, None, 0, None)
    put_pages(tmp_path, ["a"])
    assert take(spark, tmp_path, "r2", budget=2) == ("a", "a", 1, None)


# --- Merge

RUN = "run_id STRING, launch_id STRING, name STRING, run_year INT"


def merged(spark, path, rows):
    return upsert(spark.createDataFrame(rows, RUN), path, "launch_id", "run_year")


def held(spark, path):
    return sorted(map(tuple, tables.read_table(spark, path, RUN).collect()), key=str)


def test_upsert_rewrites_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "silver")
    merged(spark, path, [("1", "a", "a1", 2020), ("1", "b", "b1", 2021), ("1", "c", "c1", 2022), ("1", "d", "d1", None)])
    before = stamps(path, "run_year=2021")
    touched = merged(spark, path, [("2", "b", "b2", 2021), ("2", "e", "e2", 2021), ("0", "e", "old", 2021), ("2", None, "no key", 2021)])
    assert [r["run_year"] for r in touched.collect()] == [2021]
    assert stamps(path, "run_year=2021") == before
    want = [("1", "a", "a1", 2020), ("1", "c", "c1", 2022), ("1", "d", "d1", None), ("2", "b", "b2", 2021), ("2", "e", "e2", 2021)]
    assert held(spark, path) == sorted(want, key=str)


def test_upsert_moves_keys_and_drops_emptied_partitions(spark, tmp_path):
    path = str(tmp_path / "silver")
    merged(spark, path, [("1", "a", "a1", 2020), ("1", "b", "b1", 2021), ("1", "d", "d1", None)])
    merged(spark, path, [("2", "a", "a2", 2021), ("2", "d", "d2", 2021)])
    assert held(spark, path) == sorted([("2", "a", "a2", 2021), ("1", "b", "b1", 2021), ("2", "d", "d2", 2021)], key=str)
    assert sorted(p.name for p in Path(path).glob("run_year=*")) == ["run_year=2021"]
    again = held(spark, path)
    merged(spark, path, [("2", "a", "a2", 2021), ("1", "b", "late", 2019)])
    # of one key and run the row that is last in order stays; nothing older comes back
    assert [r for r in held(spark, path) if r[1] != "b"] == [r for r in again if r[1] != "b"]
    merged(spark, path, [("0", "a", "older", 2018)])
    assert [r for r in held(spark, path) if r[1] == "a"] == [("2", "a", "a2", 2021)]


def test_accumulated_batches_equal_one(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for run in range(4):
        rows = [{"run_id": str(run), "launch_id": str(k), "name": f"{k}-{run}"} for k in range(run, run + 3)]
        (folder / f"{run}.json").write_text("\n".join(map(json.dumps, rows)))

    def go(target):
        accumulate_runs(
            spark, str(folder), "run_id STRING, launch_id STRING, name STRING", f"{tmp_path}/{target}", f"{tmp_path}/at-{target}",
            "launch_id", "run_year", bytes_per_batch=150, transform=lambda df: df.withColumn("run_year", F.col("run_id").cast("int")),
        )
        return held(spark, f"{tmp_path}/{target}")

    want = [("0", "0", "0-0", 0), ("1", "1", "1-1", 1), ("2", "2", "2-2", 2), ("3", "3", "3-3", 3), ("3", "4", "4-3", 3), ("3", "5", "5-3", 3)]
    assert go("silver") == want
    assert len(list((tmp_path / "at-silver" / "commits").glob("[0-9]*"))) > 1
    assert go("silver") == want


# --- Partial rebuild of Gold, pruning, buckets


@pytest.fixture(scope="module")
def written(spark, sf_dir):
    base = upkeep.written_silver(spark, sf_dir, "kept", "launches", "weather", "images")
    job.run_gold(spark, base, f"{base}/gold")
    return base


def test_gold_update_writes_changed_years_only(spark, written):
    launches = job.read_silver(spark, written, "launches")
    years = spark.createDataFrame([(1997,), (None,)], "launch_year INT")
    before = stamps(f"{written}/gold", "launch_year=1997", "launch_year=__HIVE")
    turned = launches.where("launch_year = 1997").withColumn("is_success", F.lit(1))
    path = new_workspace(spark, "turned")
    turned.write.parquet(path)
    sinks.replace_partitions(spark.read.parquet(path), f"{written}/launches", "launch_year", years.where("launch_year = 1997"))
    job.update_gold(spark, written, f"{written}/gold", years)
    assert stamps(f"{written}/gold", "launch_year=1997", "launch_year=__HIVE") == before
    launches = job.read_silver(spark, written, "launches")
    whole = gold.company_year_metrics(launches)
    kept = tables.read_table(spark, f"{written}/gold/company_year_metrics", whole.schema)
    assert kept.exceptAll(whole.select(kept.columns)).isEmpty() and kept.count() == whole.count()
    features = gold.launch_features(launches, job.read_silver(spark, written, "weather"), job.read_silver(spark, written, "images"))
    kept = tables.read_table(spark, f"{written}/gold/launch_features", features.schema)
    assert kept.exceptAll(features.select(kept.columns)).isEmpty() and kept.count() == features.count()


def test_years_choose_the_folders(spark, written):
    launches = job.read_silver(spark, written, "launches")
    metrics = tables.load_metrics(tables.read_table(spark, f"{written}/gold/company_year_metrics"))
    static = global_filter(launches, 1996, 1999)
    assert "launch_year#" in plan_of(static).split("PartitionFilters:")[1].split("\n")[0]
    season = history.season_heatmap(launches, global_filter(metrics, 1996, 1999))
    assert "Subquery" in plan_of(season).split("PartitionFilters:")[1].split("\n")[0]
    busiest = upkeep.busiest_years(launches, metrics, 2)
    assert "dynamicpruning" in plan_of(busiest)
    years = sorted(r["launch_year"] for r in busiest.select("launch_year").distinct().collect())
    best = metrics.groupBy("launch_year").agg(F.sum("total_launches").alias("n")).orderBy(F.desc("n"), "launch_year").limit(2)
    assert years == sorted(r["launch_year"] for r in best.collect())


def test_buckets_are_joined_in_place(spark, sf_dir):
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(upkeep.bucketed_features(spark, sf_dir), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    # only the branch of hot launches, which is empty here, deals rows by launch and part
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(launch_id" in line]
    assert all("_part" in line for line in moved)
    assert plan.count("Bucketed: true") >= 3


def test_status_reads_footers_only(spark, written):
    found = status.written_status(spark, {"launches": (f"{written}/launches", ["launch_year"], "launch_date")})
    plan = plan_of(found)
    assert "PushedAggregation: [COUNT(*), COUNT(launch_date)]" in plan
    row = found.first()
    launches = job.read_silver(spark, written, "launches")
    assert (row["rows"], row["filled"]) == (launches.count(), launches.where("launch_date is not null").count())
    assert row["partitions"] == len([p for p in Path(f"{written}/launches").iterdir() if p.is_dir()])
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


# --- Running totals, pages, broken files, arrays


def test_running_totals_of_a_hot_group(spark):
    rows = [("hot", k, k % 7) for k in range(3000)] + [("b", 1, 5), (None, 1, 2), (None, 2, 3), ("c", 1, None)]
    df = spark.createDataFrame(rows, "g STRING, v INT, n INT").repartition(5)
    total = with_running_total(df, "upto", "n", "g", "v")
    got = {(r["g"], r["v"]): r["upto"] for r in total.collect()}
    assert len(got) == len(rows)
    running = 0
    for k in range(3000):
        running += k % 7
        assert got["hot", k] == running
    assert (got["b", 1], got[None, 1], got[None, 2]) == (5, 2, 5)
    assert with_running_total(df.limit(0), "upto", "n", "g", "v").count() == 0


def test_written_pages_equal_sorted_ones(spark, sf_dir):
    images = tables.load_images(upkeep.Tables(spark, sf_dir).images)
    path = new_workspace(spark, "pages")
    gallery.write_pages(images, path)
    n = images.count()
    for page in (0, 3, n // 20, n // 20 + 1):
        want = [tuple(r) for r in gallery.gallery_page(images, page).collect()]
        assert [tuple(r) for r in gallery.written_page(spark, path, page).collect()] == want
    assert "GreaterThanOrEqual(position" in plan_of(gallery.written_page(spark, path, 3))


def test_broken_files_are_named(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).withColumn("y", F.col("id") % 2).write.partitionBy("y").parquet(path)
    spark.range(0).write.parquet(f"{path}/y=9")
    assert tables.quarantine(spark, path).count() == 0
    whole = sorted(Path(path, "y=0").glob("part-*.parquet"))[0]
    content = whole.read_bytes()
    (Path(path, "y=0") / "part-cut.parquet").write_bytes(content[: len(content) // 2])
    (Path(path, "y=1") / "part-empty.parquet").write_bytes(b"")
    found = {(r["file"], r["length"]) for r in tables.quarantine(spark, path).collect()}
    assert found == {("part-cut.parquet", len(content) // 2)}
    read = tables.read_table(spark, path, "id BIGINT, y INT", skip_corrupt=True)
    assert sorted(r["id"] for r in read.collect()) == list(range(100))


@pytest.mark.parametrize("text, ids", [("\n\n  [\n {\"id\":\n\"1\"},\n {\"id\": \"2\"}]\n", ["1", "2"]), ("[]", []), ("", []), ("{\"id\": \"3\"}\nno\n", ["3"])])
def test_documents_on_any_lines(spark, tmp_path, text, ids):
    (tmp_path / "d.json").write_text(text)
    assert sorted(r["id"] for r in landing.read_documents(spark, f"{tmp_path}/d.json", "id STRING").collect()) == ids


def test_pretty_array_comes_back(spark, tmp_path):
    rows = spark.createDataFrame([("1", "A", None), ("2", "B", ["x"])], "id STRING, name STRING, flickr_images ARRAY<STRING>")
    sinks.write_json_array(rows, f"{tmp_path}/a")
    assert len(next(Path(tmp_path, "a").glob("part-*")).read_text().splitlines()) > 4
    back = landing.read_documents(spark, f"{tmp_path}/a", schemas.ROCKET)
    assert sorted(r["name"] for r in silver.silver_rockets(back).select(F.col("rocket_name").alias("name")).collect()) == ["A", "B"]
