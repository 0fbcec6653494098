"""Running totals of large groups, in parts that follow each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from skyledger.session import ensure_checkpointing


def with_running_total(df: DataFrame, name: str, measure: str, group: str, *order: Column | str) -> DataFrame:
    """Add the sum of ``measure`` over the rows of the group up to each row, in an order
    that leaves no ties.

    A range-partitioned sort by group and order places the rows, so a group of any size
    is dealt to as many tasks as it needs. Each task adds up its own part of a group; the
    sums of the parts before (one row for each part and group in it) are added to them.
    The sorted rows are checkpointed in between: both uses must see the same partitions,
    also when a lost executor makes Spark run tasks again. Runs one job.
    """
    ensure_checkpointing(df.sparkSession)
    placed = df.orderBy(group, *order).withColumn("_part", F.spark_partition_id()).checkpoint()
    sums = placed.groupBy(group, "_part").agg(F.sum(measure).alias("_sum"))
    before = sums.select(
        group,
        "_part",
        (F.sum("_sum").over(Window.partitionBy(group).orderBy("_part")) - F.col("_sum")).alias("_before"),
    )
    within = Window.partitionBy("_part", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    own = placed.withColumn(name, F.sum(measure).over(within))
    # at most as many rows as there are groups and parts
    return (
        own.join(F.broadcast(before), (own[group].eqNullSafe(before[group])) & (own["_part"] == before["_part"]))
        .withColumn(name, F.col(name) + F.col("_before"))
        .select(*(own[c] for c in df.columns), name)
    )
