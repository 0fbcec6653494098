"""Estimated launch costs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.numbers import clipped, exact_mean, half_even, money_sum, percentage
from skyledger.functions.text import first_word
from skyledger.operators.topk import keep_top, with_share

COST = "estimated_cost_usd"


def _priced(costs: DataFrame, *keys: str) -> DataFrame:
    return costs.dropna(subset=[COST, *keys])


def _millions(value: Column) -> Column:
    return half_even(value / 1e6, 1)


def cost_kpis(costs: DataFrame) -> DataFrame:
    """One row: total, mean, mean over successes, launches, providers."""
    of_success = F.when(F.col("is_success") == 1, F.col(COST))
    return _priced(costs).agg(
        money_sum(F.col(COST)).cast("double").alias("total_cost"),
        exact_mean(F.col(COST)).alias("mean_cost"),
        exact_mean(of_success).alias("mean_cost_success"),
        F.count("*").alias("launches"),
        F.countDistinct("provider_name").alias("providers"),
    )


def _mean_cost_by(costs: DataFrame, key: str) -> DataFrame:
    return _priced(costs, key).groupBy(key).agg(exact_mean(F.col(COST)).alias("mean_cost"))


def cost_by_provider(costs: DataFrame) -> DataFrame:
    """Mean cost in millions, cheapest provider first."""
    means = _mean_cost_by(costs, "provider_name").orderBy("mean_cost", "provider_name")
    return means.select("provider_name", _millions(F.col("mean_cost")).alias("cost_m"))


def cost_trend_top5(costs: DataFrame, n: int = 5) -> DataFrame:
    """Mean cost per year of the ``n`` providers with the highest mean cost.

    Sums and counts per year and provider serve both the ranking and the trend.
    """
    facts = _priced(costs, "provider_name").groupBy("launch_year", "provider_name").agg(
        money_sum(F.col(COST)).alias("cost"), F.count("*").alias("launches")
    )
    mean = F.sum("cost").cast("double") / F.sum("launches")
    leaders = keep_top(facts, n, "provider_name", mean).where(F.col("launch_year").isNotNull())
    return leaders.select(
        "launch_year",
        "provider_name",
        _millions(F.col("cost").cast("double") / F.col("launches")).alias("cost_m"),
    ).orderBy("provider_name", "launch_year")


def cost_by_year(costs: DataFrame) -> DataFrame:
    """Total cost in thousand millions."""
    total = money_sum(F.col(COST)).cast("double")
    yearly = _priced(costs, "launch_year").groupBy("launch_year").agg(total.alias("cost"))
    return yearly.select("launch_year", half_even(F.col("cost") / 1e9, 3).alias("cost_b")).orderBy(
        "launch_year"
    )


def cost_vs_success(costs: DataFrame) -> DataFrame:
    """Mean cost against success rate, one marker per provider."""
    grouped = _priced(costs, "provider_name").groupBy("provider_name").agg(
        exact_mean(F.col(COST)).alias("mean_cost"),
        F.sum("is_success").alias("success"),
        F.count("is_success").alias("known"),
        F.count(COST).alias("launches"),
    )
    return grouped.select(
        "provider_name",
        (F.col("mean_cost") / 1e6).alias("cost_m"),
        percentage(F.col("success"), F.col("known"), 1).alias("success_pct"),
        "launches",
        clipped(F.col("launches") / 5, 10.0, 40.0).alias("marker_size"),
        first_word(F.col("provider_name")).alias("label"),
    )


def cost_category(costs: DataFrame) -> DataFrame:
    """Launches, their share and mean cost of each category."""
    grouped = _priced(costs, "cost_category").groupBy("cost_category").agg(
        F.count(COST).alias("launches"), exact_mean(F.col(COST)).alias("mean_cost")
    )
    return with_share(grouped, "launches")


def cost_by_mission(costs: DataFrame) -> DataFrame:
    """Mean cost in millions, most expensive mission type first."""
    means = _mean_cost_by(costs, "mission_type").orderBy(F.desc("mean_cost"), "mission_type")
    return means.select("mission_type", _millions(F.col("mean_cost")).alias("cost_m"))
