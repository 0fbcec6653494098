"""Incremental landing: each file once, resumable, equal to a batch read."""

from __future__ import annotations

import json

from skyledger.plans.silver import silver_launches
from skyledger.sources import landing, schemas
from skyledger.streaming.landing import land_new_files


def put(folder, name, ids):
    lines = [json.dumps({"id": i, "net": "2020-01-02T00:00:00Z"}) for i in ids]
    (folder / name).write_text("\n".join(lines))


def land(spark, base, checkpoint="cursor", target="silver"):
    land_new_files(
        spark,
        f"{base}/in",
        schemas.LAUNCH,
        f"{base}/{target}",
        f"{base}/{checkpoint}",
        files_per_batch=2,
        transform=silver_launches,
        partition_by=["launch_year"],
    )
    rows = spark.read.parquet(f"{base}/{target}").select("launch_id").collect()
    return sorted(r["launch_id"] for r in rows)


def test_new_files_land_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(5):
        put(folder, f"page{i}.jsonl", [f"a{i}", f"b{i}"])
    batch = silver_launches(landing.read_json(spark, str(folder), schemas.LAUNCH))
    expected = sorted(r["launch_id"] for r in batch.collect())
    assert land(spark, tmp_path) == expected
    assert len(list((tmp_path / "cursor" / "commits").glob("[0-9]*"))) == 3
    assert land(spark, tmp_path) == expected
    put(folder, "page9.jsonl", ["new"])
    assert land(spark, tmp_path) == sorted([*expected, "new"])
    assert land(spark, tmp_path, "reset", "again") == sorted([*expected, "new"])
