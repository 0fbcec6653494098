"""Run manifests and status reports."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skyledger.constants import MANIFEST_FILE, RUN_ID_FORMAT
from skyledger.operators.topk import top_n
from skyledger.sources.landing import read_json, run_ids
from skyledger.sources.sinks import write_json_lines

#: Directory name of a missing partition value.
NO_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _stacked(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def run_manifest(datasets: dict[str, DataFrame]) -> DataFrame:
    """Rows per dataset of a run."""
    return _stacked(
        [
            df.agg(F.lit(name).alias("dataset"), F.count("*").alias("rows"))
            for name, df in datasets.items()
        ]
    )


def manifest_document(
    manifest: DataFrame, config: dict[str, str | int | bool], executed_at: str | None = None
) -> DataFrame:
    """The manifest as one JSON record: when, counts per dataset, configuration.
    It gathers one row per dataset of the run."""
    now = executed_at or datetime.now(timezone.utc).isoformat()
    return manifest.agg(
        F.lit(now).alias("executed_at_utc"),
        F.map_from_entries(F.collect_list(F.struct("dataset", "rows"))).alias("files"),
        F.struct(*[F.lit(value).alias(name) for name, value in config.items()]).alias("config"),
    )


def land_run(
    spark: SparkSession,
    base: str,
    datasets: dict[str, DataFrame],
    config: dict[str, str | int | bool],
    run_id: str | None = None,
) -> str:
    """Write one RAW run: every dataset as JSON lines, then the manifest.

    The manifest counts the lines as they are written: nothing is read again.
    Returns the run id.
    """
    run = run_id or datetime.now(timezone.utc).strftime(RUN_ID_FORMAT)
    counts = {}
    for name, df in datasets.items():
        seen = Observation(name)
        write_json_lines(df.observe(seen, F.count(F.lit(1)).alias("rows")), f"{base}/{run}/{name}")
        counts[name] = seen.get["rows"]
    landed = spark.createDataFrame(list(counts.items()), "dataset string, rows bigint")
    manifest = manifest_document(landed, config)
    write_json_lines(manifest, f"{base}/{run}/{MANIFEST_FILE}")
    return run


def data_status(landed: DataFrame, datasets: list[str], runs: int = 5) -> DataFrame:
    """Rows per dataset of the newest runs; a dataset a run lacks counts 0.

    ``landed`` has one row per landed record with ``run_id`` and ``dataset``.
    """
    counts = landed.groupBy("run_id").agg(
        *[F.count_if(F.col("dataset") == name).alias(name) for name in datasets]
    )
    newest = top_n(counts, runs, "run_id")
    return newest.unpivot(["run_id"], datasets, "dataset", "rows")


def landed_status(spark: SparkSession, base: str, datasets: list[str], runs: int = 5) -> DataFrame:
    """Lines per dataset of the newest run folders under ``base``; a dataset that a run
    lacks counts 0. Folders are chosen first, and no others are read."""
    parts = [
        read_json(spark, f"{base}/{run}/{name}", "value STRING").agg(
            F.lit(run).alias("run_id"), F.lit(name).alias("dataset"), F.count("*").alias("rows")
        )
        for run in run_ids(spark, base)[:runs]
        for name in datasets
    ]
    return _stacked(parts)


def table_partitions(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Number of partition folders of each table, from its partition column."""

    def folders(name: str, df: DataFrame, column: str) -> DataFrame:
        value = F.coalesce(F.col(column).cast("string"), F.lit(NO_PARTITION))
        return df.agg(
            F.lit(name).alias("table_name"), F.countDistinct(value).alias("partitions")
        )

    return _stacked([folders(name, df, column) for name, (df, column) in tables.items()])


#: File formats that a session for footers reads the old way; Parquet is not among them.
_OLD_READERS = "avro,csv,json,kafka,orc,text"


def written_status(spark: SparkSession, written: dict[str, tuple[str, list[str], str]]) -> DataFrame:
    """(table_name, partitions, first, last, rows, filled) of written Parquet tables, given as
    name: (path, partition columns, column), from file footers alone.

    ``partitions`` counts folders of the first partition column, ``first`` and ``last`` are
    their bounds, ``filled`` counts rows whose column is not missing. Counts are pushed into
    the scan, which adds up what the footers say; no column is read. A session of its own
    holds the settings that this takes; the caller's stay as they are.
    """
    footers = spark.newSession()
    footers.conf.set("spark.sql.sources.useV1SourceList", _OLD_READERS)
    footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")

    def one(name: str, path: str, columns: list[str], column: str) -> DataFrame:
        folders = footers.read.parquet(path).groupBy(*columns).agg(
            F.count("*").alias("rows"), F.count(column).alias("filled")
        )
        value = F.col(columns[0]).cast("string")
        return folders.agg(
            F.lit(name).alias("table_name"),
            F.countDistinct(F.coalesce(value, F.lit(NO_PARTITION))).alias("partitions"),
            F.min(value).alias("first"),
            F.max(value).alias("last"),
            F.sum("rows").alias("rows"),
            F.sum("filled").alias("filled"),
        )

    return _stacked([one(name, *table) for name, table in written.items()])
