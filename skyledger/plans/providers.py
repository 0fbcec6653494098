"""Provider rankings, trends and shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from skyledger.constants import OTHERS_LABEL, PROVIDER_TABLE_HEADINGS
from skyledger.functions.numbers import percentage, sum_or_zero
from skyledger.functions.text import fixed
from skyledger.operators.topk import keep_top, numbered, top_n, with_remainder, with_share


def _named(metrics: DataFrame) -> DataFrame:
    return metrics.where(F.col("provider_name").isNotNull())


def provider_stats(metrics: DataFrame) -> DataFrame:
    totals = _named(metrics).groupBy("provider_name").agg(
        sum_or_zero(F.col("total_launches")).alias("total"),
        sum_or_zero(F.col("successful_launches")).alias("success"),
    )
    return totals.withColumn("rate", percentage(F.col("success"), F.col("total"), 1))


def provider_top12(metrics: DataFrame, n: int = 12) -> DataFrame:
    return top_n(provider_stats(metrics), n, "total", "provider_name").select(
        "provider_name", "total"
    )


def provider_rate_top10(metrics: DataFrame, n: int = 10) -> DataFrame:
    return top_n(provider_stats(metrics), n, "total", "provider_name").select(
        "provider_name", "rate"
    )


def provider_rate_trend(metrics: DataFrame, n: int = 6) -> DataFrame:
    """Yearly success rate of the ``n`` largest providers."""
    facts = _named(metrics).select(
        "launch_year", "provider_name", "success_rate_pct", "total_launches"
    )
    leaders = keep_top(facts, n, "provider_name", F.sum("total_launches"))
    return leaders.drop("total_launches").orderBy("provider_name", "launch_year")


def market_share(metrics: DataFrame, n: int = 8) -> DataFrame:
    """The ``n`` largest providers and all others in one row, with their shares."""
    totals = provider_stats(metrics).select(F.col("provider_name").alias("name"), "total")
    return with_share(with_remainder(totals, n, "name", "total", OTHERS_LABEL), "total")


def provider_table(metrics: DataFrame, n: int = 15) -> DataFrame:
    """The summary table as displayed."""
    best = top_n(provider_stats(metrics), n, "total", "provider_name")
    shown = best.withColumn("rate", F.concat(fixed(F.col("rate"), 1), F.lit("%")))
    return shown.withColumnsRenamed(PROVIDER_TABLE_HEADINGS)


def race_cumulative(metrics: DataFrame, n: int = 15) -> DataFrame:
    """Running totals of the ``n`` largest providers in every year, years without
    launches included, and their place in that year, smallest first.

    The grid is each year exploded by a scalar array of ``n`` providers.
    """
    facts = _named(metrics).groupBy("launch_year", "provider_name").agg(
        F.sum("total_launches").alias("launches")
    )
    totals = facts.groupBy("provider_name").agg(F.sum("launches").alias("total"))
    leaders = numbered(
        top_n(totals, n, "total", "provider_name"), "seat", F.desc("total"), "provider_name"
    )
    roster = leaders.agg(F.collect_list(F.struct("seat", "provider_name"))).scalar()
    years = metrics.select("launch_year").distinct()
    grid = years.withColumn("_entry", F.explode(roster)).select("launch_year", "_entry.*")
    so_far = Window.partitionBy("provider_name").orderBy("launch_year")
    frame = Window.partitionBy("year").orderBy("running", "seat")
    return (
        grid.join(facts, ["launch_year", "provider_name"], "left")
        .select(
            F.col("launch_year").alias("year"),
            F.col("provider_name").alias("provider"),
            F.sum(F.coalesce("launches", F.lit(0))).over(so_far).alias("running"),
            "seat",
        )
        .withColumn("position", F.row_number().over(frame))
        .drop("seat")
    )
