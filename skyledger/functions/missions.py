"""Mission type and orbit from a launch name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.constants import DEFAULT_PROFILE, EVERY_FIFTH_PROFILE, MISSION_RULES


def mission_profile(name: Column, variant: Column) -> Column:
    """Struct ``(type, orbit)`` of the first rule whose keyword is in ``name``."""
    text = F.lower(name)
    profile = None
    for keywords, mission_type, orbit in MISSION_RULES:
        hit = text.rlike("|".join(keywords))
        profile = (F if profile is None else profile).when(hit, _pair(mission_type, orbit))
    return profile.when(variant % 5 == 0, _pair(*EVERY_FIFTH_PROFILE)).otherwise(
        _pair(*DEFAULT_PROFILE)
    )


def _pair(mission_type: str, orbit: str) -> Column:
    return F.struct(F.lit(mission_type).alias("type"), F.lit(orbit).alias("orbit"))
