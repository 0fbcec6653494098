"""The launch table as displayed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.constants import EXPLORER_HEADINGS, EXPLORER_RESULTS
from skyledger.functions.numbers import half_even
from skyledger.functions.outcomes import labelled


def launch_explorer(features: DataFrame) -> DataFrame:
    """Eleven columns under their display names, newest year first. Within a year
    the id decides, so that a year with very many launches sorts in many tasks."""
    ordered = features.orderBy(F.desc("launch_year"), "launch_id")
    shown = ordered.select(*EXPLORER_HEADINGS).withColumns(
        {
            "is_success": labelled(F.col("is_success"), *EXPLORER_RESULTS),
            "temperature_2m_mean": half_even(F.col("temperature_2m_mean"), 1),
            "wind_speed_10m_max": half_even(F.col("wind_speed_10m_max"), 1),
        }
    )
    return shown.withColumnsRenamed(EXPLORER_HEADINGS)
