"""Accumulating runs in a partitioned table: new rows replace older ones of their key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.latest import newest_per_key
from skyledger.session import new_workspace
from skyledger.sources.sinks import delete_path, path_exists, replace_partitions, stored_bytes
from skyledger.sources.tables import read_table


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: it does not change any more,
    whatever happens to the tables that it was made of."""
    path = new_workspace(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def upsert(batch: DataFrame, path: str, key: str, partition: str) -> DataFrame:
    """Merge ``batch`` (with ``run_id``) into the table at ``path``; returns the values of
    ``partition`` that were rewritten.

    Each key keeps the row of its newest run, wherever it stood before. Only partitions
    that hold a row of the batch, before or after, are read as a whole and written again;
    of the others keys alone are read. Merging a batch twice changes nothing, so a stream
    may repeat one after a failure. Rows without a key are left out.
    """
    spark = batch.sparkSession
    fresh = staged(newest_per_key(batch, key), "upsert-batch")
    if not path_exists(spark, path):
        touched = fresh.select(partition).distinct()
        replace_partitions(fresh, path, partition, touched)
        return touched
    current = read_table(spark, path, fresh.schema)
    before = current.select(key, partition).join(fresh.select(key), key, "left_semi").select(partition)
    touched = staged(fresh.select(partition).unionByName(before).distinct(), "upsert-partitions")
    # one row a partition: its values choose the folders to read
    held = current.join(F.broadcast(touched.where(F.col(partition).isNotNull())), partition, "left_semi")
    if not touched.where(F.col(partition).isNull()).isEmpty():
        held = held.unionByName(current.where(F.col(partition).isNull()))
    merged = staged(newest_per_key(held.select(fresh.columns).unionByName(fresh), key), "upsert-merged")
    replace_partitions(merged, path, partition, touched)
    return touched


#: Batches wait until they hold so many times the bytes of the table they are merged into.
GROWTH = 3


def accumulate_runs(
    spark: SparkSession,
    source: str,
    schema: str,
    path: str,
    checkpoint: str,
    key: str,
    partition: str,
    *,
    bytes_per_batch: int = 16 << 30,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Take the JSON files that have arrived under ``source`` since the last call, batch by
    batch, and ``upsert`` them. The checkpoint remembers which files were taken.

    A batch is written beside the checkpoint and waits there. What waits is merged as soon as
    it holds ``GROWTH`` times the bytes of the table, and at the end of the call: as the table
    grows by that factor from merge to merge, all of them together rewrite its rows a few
    times, however many batches there are. A call that breaks off leaves batches waiting,
    which the next one merges; a batch that is repeated replaces itself.
    """
    waiting = f"{checkpoint}/waiting"

    def merge() -> None:
        try:
            landed = read_table(spark, f"{waiting}/*")
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return  # nothing waits, or only folders that a call broke off deleting
        upsert(landed, path, key, partition)
        delete_path(spark, waiting)

    def land(batch: DataFrame, number: int) -> None:
        rows = transform(batch) if transform else batch
        rows.write.mode("overwrite").parquet(f"{waiting}/{number}")
        if not path_exists(spark, path) or stored_bytes(spark, waiting) >= GROWTH * stored_bytes(spark, path):
            merge()

    rows = spark.readStream.schema(schema).option("maxBytesPerTrigger", bytes_per_batch).json(source)
    query = (
        rows.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    merge()
