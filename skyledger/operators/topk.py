"""Top-k shapes. All work on grouped rows and never bring them to the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def top_n(df: DataFrame, n: int, measure: str, *tie_keys: str) -> DataFrame:
    """The ``n`` rows with the largest measure, ties by key ascending."""
    return df.orderBy(F.desc(measure), *tie_keys).limit(n)


def keep_top(facts: DataFrame, n: int, key: str, ranking: Column) -> DataFrame:
    """Rows of grouped ``facts`` whose key is among the ``n`` best by ``ranking``
    (an aggregate over the facts of that key).

    The leaders are an inner join, not a semi join: Spark would push a semi join
    below the aggregation of ``facts`` and so scan and aggregate twice, while this
    way the one shuffle of ``facts`` serves both sides. The broadcast side holds
    at most ``n`` rows by construction.
    """
    leaders = top_n(facts.groupBy(key).agg(ranking.alias("_rank")), n, "_rank", key)
    return facts.join(F.broadcast(leaders.select(key)), key).select(facts.columns)


def top_per_group(df: DataFrame, group: str, n: int, measure: str, *tie_keys: str) -> DataFrame:
    """The ``n`` best rows of each group, numbered in ``place``. Spark keeps only
    the ``n`` best of a group in each task before it shuffles."""
    best_first = Window.partitionBy(group).orderBy(F.desc(measure), *tie_keys)
    return df.withColumn("place", F.row_number().over(best_first)).where(F.col("place") <= n)


def numbered(df: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """Number the rows of a table already cut to a few rows (one task does it)."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def with_remainder(df: DataFrame, n: int, key: str, measure: str, rest_label: str) -> DataFrame:
    """The top ``n`` rows, and one row with the sum of all others."""
    leaders = top_n(df.select(key, measure), n, measure, key)
    everything = df.agg(F.coalesce(F.sum(measure), F.lit(0))).scalar()
    rest = leaders.agg(
        F.lit(rest_label).alias(key),
        (everything - F.coalesce(F.sum(measure), F.lit(0))).alias(measure),
    )
    return leaders.unionByName(rest)


def with_share(df: DataFrame, measure: str, name: str = "share") -> DataFrame:
    """Add each row's part of the column total; the total is one scalar, so the
    rows stay where they are."""
    total = df.agg(F.sum(measure)).scalar()
    return df.withColumn(name, F.try_divide(F.col(measure), total))
