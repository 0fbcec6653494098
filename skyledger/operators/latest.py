"""Picking rows by run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_run(df: DataFrame, run_id: str | None = None) -> DataFrame:
    """Rows of the newest run, or of the run asked for."""
    newest = df.agg(F.max("run_id")).scalar()
    return df.where(F.col("run_id") == (newest if run_id is None else run_id))


def newest_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key: that of its newest run.

    A struct maximum combines on the map side, so a key with very many rows
    sends one row per task; a window would sort all of them in one task. Rows of
    one key and run are told apart by their remaining columns, in order.
    """
    rest = [c for c in df.columns if c not in (key, "run_id")]
    best = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.max(F.struct("run_id", *rest)).alias("_best")
    )
    return best.select(key, "_best.*").select(df.columns)
