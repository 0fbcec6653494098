"""Activity over time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from skyledger.functions.numbers import percentage, sum_or_zero
from skyledger.operators.topk import keep_top


def yearly_activity(metrics: DataFrame, rolling_rows: int = 5) -> DataFrame:
    """Totals per year with rolling rate and running totals.

    The windows have no partition key; by then there is one row per year. The
    rolling mean spans rows, not years: a year without launches has no row.
    """
    yearly = metrics.groupBy(F.col("launch_year").alias("year")).agg(
        sum_or_zero(F.col("total_launches")).alias("total"),
        sum_or_zero(F.col("successful_launches")).alias("success"),
    )
    by_year = Window.orderBy("year")
    recent = by_year.rowsBetween(1 - rolling_rows, Window.currentRow)
    so_far = by_year.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        yearly.withColumn("failed", F.greatest(F.col("total") - F.col("success"), F.lit(0)))
        .withColumn("rate", percentage(F.col("success"), F.col("total"), 2))
        .withColumn("rolling", F.avg("rate").over(recent))
        .withColumn("cumulative", F.sum("total").over(so_far))
        .withColumn("cum_success", F.sum("success").over(so_far))
        .orderBy("year")
    )


def top_provider_trend(metrics: DataFrame, n: int = 5) -> DataFrame:
    """Launches per year of the ``n`` providers with most launches."""
    facts = metrics.where(F.col("provider_name").isNotNull()).select(
        "launch_year", "provider_name", "total_launches"
    )
    leaders = keep_top(facts, n, "provider_name", F.sum("total_launches"))
    return leaders.orderBy("provider_name", "launch_year")


def season_heatmap(launches: DataFrame, metrics: DataFrame) -> DataFrame:
    """Launches per year and month, within the years the metrics cover. Where launches are
    partitioned by year, these choose the folders to read."""
    first = metrics.agg(F.min("launch_year")).scalar()
    last = metrics.agg(F.max("launch_year")).scalar()
    months = list(range(1, 13))
    grid = (
        launches.where(F.col("launch_date").isNotNull() & F.col("launch_year").between(first, last))
        .select(F.col("launch_year").alias("year"), F.month("launch_date").alias("month"))
        .groupBy("year")
        .pivot("month", months)
        .count()
        .na.fill(0)
    )
    return grid.select("year", *[F.col(str(m)).alias(f"m{m}") for m in months]).orderBy("year")
