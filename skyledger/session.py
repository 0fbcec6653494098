"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings every job relies on. Adaptive execution merges small shuffle
#: partitions and splits skewed ones, so counts need only be large enough.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

MIB, TIB = 2**20, 2**40


def sizing(input_bytes: int) -> dict[str, str]:
    """Scan and shuffle sizes for an input of ``input_bytes``.

    Shuffles start with partitions of about 256 MiB, assuming that a tenth of the
    input survives column pruning; adaptive execution merges them where less
    does. Scan tasks grow with the cube root of the input, from 128 MiB at 1 TiB to
    some 600 MiB at 100 TiB, so that the number of tasks grows more slowly than the
    input; shuffles are merged to half of that.
    """
    partitions = max(input_bytes // 10 // (256 * MIB), 200)
    scan = int(128 * max(1.0, input_bytes / TIB) ** (1 / 3))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(scan * MIB),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(scan * MIB // 2),
    }


def build_session(
    app_name: str = "skyledger",
    master: str | None = None,
    input_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the settings above; ``input_bytes`` sizes scans and shuffles,
    ``conf`` has the last word."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    sized = sizing(input_bytes) if input_bytes else {}
    for key, value in {**SETTINGS, **sized, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    A folder of the process, removed when it ends, stands in for it only in local
    mode, where driver and executors are one process; a cluster without the setting,
    also a local one of several processes, is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="skyledger-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def ensure_checkpointing(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable on this session."""
    folder = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)


def new_workspace(spark: SparkSession, label: str) -> str:
    """A path, never used before, under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
