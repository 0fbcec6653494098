"""Consecutive row numbers over a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from skyledger.session import ensure_checkpointing


def with_row_index(df: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """Add the 0-based position of each row in the given order.

    A range-partitioned sort places the rows, each task numbers its own, and the
    (one row per task) counts before it are added. The sorted rows are
    checkpointed in between: both uses must see the same partitions, also when a
    lost executor makes Spark run tasks again. Runs one job.
    """
    ensure_checkpointing(df.sparkSession)
    placed = (
        df.orderBy(*order)
        .withColumn("_placed", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_placed", 33))
        .withColumn("_local", F.col("_placed").bitwiseAND((1 << 33) - 1))
        .drop("_placed")
        .checkpoint()
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    before = sizes.select(
        "_part",
        (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_before"),
    )
    return (
        placed.join(F.broadcast(before), "_part")
        .withColumn(name, F.col("_before") + F.col("_local"))
        .drop("_part", "_local", "_before")
    )
