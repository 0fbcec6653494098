"""Joins that keep their cost in check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A literal table above this many rows is no longer sent to every executor.
LITERAL_LIMIT = 10_000

#: A key with more rows than this is divided among several tasks.
ROWS_PER_TASK = 10_000_000


def literal_lookup(df: DataFrame, rows: Sequence[tuple], schema: str, key: str) -> DataFrame:
    """Left join to a table written in the program; broadcast while it is small."""
    table = df.sparkSession.createDataFrame(list(rows), schema)
    if len(rows) <= LITERAL_LIMIT:
        table = F.broadcast(table)
    return df.join(table, key, "left")


def hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows, and into how many parts to
    divide them. Holds at most one row per ``rows_per_task`` rows of ``df``."""
    sizes = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    parts = F.ceil(F.col("_n") / rows_per_task).cast("int")
    return sizes.where(F.col("_n") > rows_per_task).select(key, parts.alias("_parts"))


def fan_out_left_join(
    left: DataFrame, right: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Left join whose right side may hold very many rows of one key.

    Usual keys join on the key alone, so earlier partitioning by it is kept. Rows
    of hot keys are dealt out over parts, with the left row in every part; a hot
    key has matches by definition, hence an inner join. Without hot keys adaptive
    execution drops that branch. Broadcasting the hot keys is safe: they are at
    most ``1 / rows_per_task`` of the right rows. Rows are dealt by a hash of the row,
    so a task that runs again deals the same way. Left rows without a key match nothing
    and stay where they are.
    """
    others = [f for f in right.schema if f.name != key]
    lone = left.where(F.col(key).isNull()).select(
        key,
        *[c for c in left.columns if c != key],
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in others],
    )
    return fan_out_keyed_left_join(left.where(F.col(key).isNotNull()), right, key, rows_per_task).unionByName(lone)


def fan_out_keyed_left_join(
    keyed: DataFrame, right: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """``fan_out_left_join`` of left rows that all have a key."""
    hot = F.broadcast(hot_keys(right, key, rows_per_task))
    cool_right = right.join(hot, key, "left_anti")
    usual = keyed.join(hot, key, "left_anti").join(cool_right, key, "left")

    part = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    left_parts = keyed.join(hot, key).withColumn("_part", part).drop("_parts")
    dealt = right.withColumn("_row", F.xxhash64(*right.columns)).join(hot, key)
    right_parts = dealt.withColumn("_part", F.pmod("_row", "_parts").cast("int")).drop(
        "_row", "_parts"
    )
    rare = left_parts.join(right_parts, [key, "_part"]).drop("_part")
    return usual.unionByName(rare)
