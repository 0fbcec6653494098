"""Incremental landing: take the files that are new, once each, and stop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def land_new_files(
    spark: SparkSession,
    source: str,
    schema: str,
    target: str,
    checkpoint: str,
    *,
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: list[str] | None = None,
) -> None:
    """Append what has arrived under ``source`` since the last call to ``target``.

    The checkpoint is the cursor: it survives lost executors and restarts, and a
    new checkpoint folder is a reset. ``files_per_batch`` is the page size; for large
    tables give ``bytes_per_batch``, so that batches do not grow in number
    with small files.
    ``transform`` must be stateless (a Silver transform is).
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    rows = reader.json(source)
    if transform:
        rows = transform(rows)
    writer = rows.writeStream.format("parquet").outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = (
        writer.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()
