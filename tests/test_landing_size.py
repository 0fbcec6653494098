"""What landings write and shuffle: compressed files, records that carry their run or page."""

from __future__ import annotations

import contextlib
import io
from pathlib import Path

from pyspark.sql import functions as F

from skyledger.bindings import catalogue, domain, upkeep
from skyledger.plans import status
from skyledger.sources import sinks


def scans(df, name):
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        df.explain("formatted")
    return sum(line.startswith("Location:") and f"/{name}.parquet" in line for line in shown.getvalue().splitlines())


def test_landed_run_is_compressed(spark, sf_dir, tmp_path):
    launches = domain.raw_launches(spark, sf_dir)
    run = status.land_run(spark, str(tmp_path), {"launches.jsonl": launches}, {"pages": 5})
    files = list(Path(tmp_path, run, "launches.jsonl").glob("part-*"))
    lines = launches.select(F.sum(F.length(F.to_json(F.struct(*launches.columns))))).first()[0]
    assert all(f.name.endswith(".json.gz") for f in files)
    assert sum(f.stat().st_size for f in files) * 4 < lines
    back = spark.read.schema(launches.schema).json(f"{tmp_path}/{run}/launches.jsonl")
    assert back.exceptAll(launches).isEmpty() and launches.exceptAll(back).isEmpty()


def test_json_files_hold_so_many_lines(spark, tmp_path):
    path = str(tmp_path / "rows")
    sinks.write_json_lines(spark.range(10).coalesce(1), path, records_per_file=4)
    assert len(list(Path(path).glob("part-*.gz"))) == 3
    assert spark.read.schema("id BIGINT").json(path).count() == 10


def test_launches_of_a_year_come_from_one_scan(spark, sf_dir, monkeypatch):
    landed = []
    monkeypatch.setattr(catalogue.status, "land_run", lambda s, base, run, config, run_id: landed.append(next(iter(run.values()))))
    monkeypatch.setattr(catalogue.status, "landed_status", lambda *_: None)
    catalogue.landed_status(spark, sf_dir)
    assert len(landed) > 1 and {scans(df, "orders") for df in landed} == {1}


def test_launches_of_a_page_come_from_one_scan(spark, sf_dir, monkeypatch):
    plans, write = [], sinks.write_json_lines

    def written(df, path, **how):
        plans.append(scans(df, "orders"))
        write(df, path, **how)

    monkeypatch.setattr(upkeep.sinks, "write_json_lines", written)
    upkeep.landing_cursor(spark, sf_dir)
    assert plans == [1]
