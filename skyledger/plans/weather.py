"""Weather at launch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.constants import FAILURE_LABEL, SUCCESS_LABEL, UNKNOWN_LABEL
from skyledger.functions.hashing import shuffle_key
from skyledger.functions.outcomes import labelled
from skyledger.operators.quantiles import exact_quantiles, quantiles_of, ranked_counts

OUTCOMES = [SUCCESS_LABEL, FAILURE_LABEL, UNKNOWN_LABEL]
TEMPERATURE = "temperature_2m_mean"
WIND = "wind_speed_10m_max"
QUARTILES = [0.25, 0.5, 0.75]


def observed(features: DataFrame) -> DataFrame:
    """Launches with both measurements, and their outcome as a label."""
    outcome = labelled(F.col("is_success"), SUCCESS_LABEL, FAILURE_LABEL, UNKNOWN_LABEL)
    return features.dropna(subset=[TEMPERATURE, WIND]).withColumn("outcome", outcome)


def _long(features: DataFrame, *keep: str) -> DataFrame:
    """One row per launch and measurement; ``series`` names measurement and outcome."""
    rows = observed(features).unpivot(
        [*keep, "outcome"], [TEMPERATURE, WIND], "measure", "reading"
    )
    return rows.withColumn("series", F.concat_ws("/", "measure", "outcome"))


def _series() -> list[str]:
    return [f"{measure}/{outcome}" for measure in (TEMPERATURE, WIND) for outcome in OUTCOMES]


def _with_fences(quartiles: DataFrame) -> DataFrame:
    """Quartiles and outlier fences: one row for each of the six series."""
    spread = 1.5 * (F.col("q3") - F.col("q1"))
    named = quartiles.select(
        "series", "total", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3")
    )
    return named.withColumn("low_fence", F.col("q1") - spread).withColumn("high_fence", F.col("q3") + spread)


def weather_box_stats(features: DataFrame) -> DataFrame:
    """Box-plot numbers per measurement and outcome, all from one count of the readings."""
    ranked = ranked_counts(_long(features), "series", "reading")
    quartiles = _with_fences(quantiles_of(ranked, "series", "reading", QUARTILES))
    inside = F.col("reading").between(F.col("low_fence"), F.col("high_fence"))
    boxes = (
        ranked.join(F.broadcast(quartiles), "series")
        .groupBy("series", "total", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("reading"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("reading"))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("outliers"),
        )
    )
    return boxes.select(
        F.split_part("series", F.lit("/"), F.lit(1)).alias("measure"),
        F.split_part("series", F.lit("/"), F.lit(2)).alias("outcome"),
        "total",
        "q1",
        "median",
        "q3",
        "whisker_low",
        "whisker_high",
        "outliers",
    )


def weather_outliers(features: DataFrame) -> DataFrame:
    """The readings drawn as single points: those outside the fences."""
    rows = _long(features, "launch_id")
    quartiles = _with_fences(exact_quantiles(rows, "series", _series(), "reading", QUARTILES))
    outside = ~F.col("reading").between(F.col("low_fence"), F.col("high_fence"))
    return (
        rows.join(F.broadcast(quartiles), "series")
        .where(outside)
        .select("launch_id", "measure", "outcome", "reading")
    )


def weather_sample(features: DataFrame, n: int = 600, seed: int = 7) -> DataFrame:
    """At most ``n`` launches in a repeatable shuffled order."""
    return (
        observed(features)
        .orderBy(shuffle_key(seed, F.col("launch_id")), "launch_id")
        .limit(n)
        .select("launch_id", "outcome", TEMPERATURE, WIND)
    )


def temp_histogram(features: DataFrame, bins: int = 35) -> DataFrame:
    """Launches per temperature bin and outcome, in equal bins over the whole range.

    Launches are counted per temperature first; the range and the bins both come from
    these counts, and share their shuffle."""
    rows = observed(features).groupBy("outcome", F.col(TEMPERATURE).alias("t")).agg(F.count("*").alias("n"))
    bounds = rows.agg(F.struct(F.min("t").alias("low"), F.max("t").alias("high"))).scalar()
    bin_no = f"least(floor(coalesce(try_divide(t - low, width), 0)) + 1, {bins})"
    return (
        rows.withColumn("bounds", bounds)
        .selectExpr("outcome", "n", "t", "bounds.low", f"(bounds.high - bounds.low) / {bins} AS width")
        .selectExpr("outcome", "n", f"cast({bin_no} AS int) AS bin", "low", "width")
        .selectExpr("outcome", "n", "bin", "low + (bin - 1) * width AS bin_start")
        .groupBy("outcome", "bin")
        .agg(F.sum("n").alias("launches"), F.min("bin_start").alias("bin_start"))
    )


def weather_by_year(features: DataFrame) -> DataFrame:
    return (
        observed(features)
        .where(F.col("launch_year").isNotNull())
        .groupBy("launch_year")
        .agg(F.avg(TEMPERATURE).alias("temp"), F.avg(WIND).alias("wind"))
        .orderBy("launch_year")
    )
