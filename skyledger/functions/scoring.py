"""Heuristic success score: base rate x temperature factor x wind factor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.constants import LOWEST_PROBABILITY_BAND, PROBABILITY_BANDS


def temperature_factor(celsius: Column) -> Column:
    """1 between 10 and 28 degrees, falling linearly to a floor on either side."""
    cold = F.greatest(F.lit(0.55), 1.0 - F.abs(celsius - 10) * 0.025)
    hot = F.greatest(F.lit(0.65), 1.0 - (celsius - 28) * 0.018)
    return F.when(celsius.between(10, 28), 1.0).when(celsius < 10, cold).when(celsius > 28, hot)


def wind_factor(kmh: Column) -> Column:
    """1 up to 30 km/h, then down to 0.6 at 60 km/h, then down to a floor of 0.05."""
    moderate = 1.0 - (kmh - 30) / 30 * 0.40
    strong = F.greatest(F.lit(0.05), 0.60 - (kmh - 60) / 60 * 0.55)
    return F.when(kmh <= 30, 1.0).when(kmh <= 60, moderate).when(kmh > 60, strong)


def success_probability(base: Column, temp_factor: Column, wind: Column) -> Column:
    """The product held in [0.01, 0.99]; null if a factor is."""
    product = base * temp_factor * wind
    return F.when(product.isNotNull(), F.least(F.lit(0.99), F.greatest(F.lit(0.01), product)))


def probability_band(percent: Column) -> Column:
    band = F
    for floor, label in PROBABILITY_BANDS:
        band = band.when(percent >= floor, label)
    return band.when(percent.isNotNull(), LOWEST_PROBABILITY_BAND)


def factor_band(factor: Column, fair_from: float) -> Column:
    """``good`` from 0.95, ``fair`` from ``fair_from``, else ``poor``."""
    return (
        F.when(factor >= 0.95, "good")
        .when(factor >= fair_from, "fair")
        .when(factor.isNotNull(), "poor")
    )
