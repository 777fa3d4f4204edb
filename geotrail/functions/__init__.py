"""Column expressions (all JVM-side, codegen friendly)."""

from geotrail.functions.geo import (
    dt_seconds,
    duration_minutes,
    haversine_m,
    java_round2,
    speed_kph,
)
from geotrail.functions.fold import rounded_mean_fold

__all__ = [
    "dt_seconds",
    "duration_minutes",
    "haversine_m",
    "java_round2",
    "rounded_mean_fold",
    "speed_kph",
]
