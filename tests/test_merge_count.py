"""Batches of runs are merged in groups: merges do not grow in number with the batches."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from skyledger.sources import sinks, tables
from skyledger.streaming import upsert

SCHEMA = "run_id STRING, launch_id STRING, name STRING"


def put_runs(base, runs):
    """A file a run; every second launch of a run comes again in the next one."""
    for run in runs:
        rows = [{"run_id": f"{run:02}", "launch_id": str(k), "name": f"{k}-{run}"} for k in range(2 * run, 2 * run + 3)]
        (base / f"{run:02}.json").write_text("\n".join(map(json.dumps, [*rows, {"run_id": f"{run:02}"}])))


def expected(runs):
    newest = {k: run for run in range(runs) for k in range(2 * run, 2 * run + 3)}
    return sorted((f"{run:02}", str(k), f"{k}-{run}", run // 10) for k, run in newest.items())


def accumulated(spark, base):
    upsert.accumulate_runs(
        spark, f"{base}/in", SCHEMA, f"{base}/silver", f"{base}/checkpoint", "launch_id", "decade",
        bytes_per_batch=1, transform=lambda df: df.withColumn("decade", F.substring("run_id", 1, 1).cast("int")),
    )
    rows = tables.read_table(spark, f"{base}/silver", f"{SCHEMA}, decade INT").collect()
    return sorted(map(tuple, rows))


@pytest.fixture
def merges(monkeypatch):
    """The number of rows of every merge."""
    counts, real = [], upsert.upsert

    def counted(batch, *rest):
        counts.append(batch.count())
        return real(batch, *rest)

    monkeypatch.setattr(upsert, "upsert", counted)
    return counts


def test_merges_are_far_fewer_than_batches(spark, tmp_path, merges):
    (tmp_path / "in").mkdir()
    put_runs(tmp_path / "in", range(16))
    assert accumulated(spark, tmp_path) == expected(16)
    assert len(list((tmp_path / "checkpoint" / "commits").glob("[0-9]*"))) == 16
    assert 1 < len(merges) < 7 and sum(merges) == 64
    put_runs(tmp_path / "in", [16])
    assert accumulated(spark, tmp_path) == expected(17)
    assert merges[-1] == 4
    before = len(merges)
    assert accumulated(spark, tmp_path) == expected(17)
    assert len(merges) == before


def test_batches_left_waiting_are_merged_by_the_next_call(spark, tmp_path, merges, monkeypatch):
    (tmp_path / "in").mkdir()
    put_runs(tmp_path / "in", range(3))

    def broken(*_):
        raise OSError("before the second merge")

    with monkeypatch.context() as patch:
        counted = upsert.upsert
        patch.setattr(upsert, "upsert", lambda *given: broken() if merges else counted(*given))
        with pytest.raises(OSError):
            accumulated(spark, tmp_path)
    assert sinks.path_exists(spark, f"{tmp_path}/checkpoint/waiting")
    assert accumulated(spark, tmp_path) == expected(3)
    Path(tmp_path, "checkpoint", "waiting", "0").mkdir(parents=True)
    assert accumulated(spark, tmp_path) == expected(3)
