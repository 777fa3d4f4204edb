"""Scalar functions X1-X5 as Spark Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geotrail.config import EARTH_RADIUS_M

# Java's Math.toRadians multiplies by this constant; mirroring it keeps distances bit-stable.
DEG_TO_RAD = 0.017453292519943295


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def haversine_m(lat1, lon1, lat2, lon2, radius_m: float = EARTH_RADIUS_M) -> Column:
    """Great-circle distance in metres: R * 2 * atan2(sqrt(a), sqrt(1 - a))."""
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    half_dlat = ((lat2 - lat1) * DEG_TO_RAD) / 2
    half_dlon = ((lon2 - lon1) * DEG_TO_RAD) / 2
    a = F.sin(half_dlat) * F.sin(half_dlat) + (
        F.cos(lat1 * DEG_TO_RAD) * F.cos(lat2 * DEG_TO_RAD)
    ) * F.sin(half_dlon) * F.sin(half_dlon)
    return F.lit(radius_m * 2) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))


def dt_seconds(from_ms, to_ms) -> Column:
    """Elapsed seconds between two epoch-ms instants."""
    return (_c(to_ms) - _c(from_ms)) / 1000.0


def speed_kph(distance_m, from_ms, to_ms) -> Column:
    """Speed in km/h; 0 when the elapsed time is not positive."""
    dt = dt_seconds(from_ms, to_ms)
    return F.when(dt <= 0, F.lit(0.0)).otherwise((_c(distance_m) / dt) * 3.6)


def java_round2(x) -> Column:
    """Two-decimal rounding, ties toward +infinity (Java Math.round(x*100)/100).

    Spark's round() rounds half away from zero on the decimal value, which
    differs (1.005 -> 1.01, -0.125 -> -0.13). Here the fractional part of
    x*100 is computed exactly (y - floor(y) is exact for doubles) and compared
    with one half.
    """
    y = _c(x) * 100.0
    fl = F.floor(y)
    return (fl + F.when(y - fl >= 0.5, F.lit(1)).otherwise(F.lit(0))) / 100.0


def duration_minutes(start_ms, end_ms) -> Column:
    """Whole minutes, truncating like Java's long division."""
    d = _c(end_ms) - _c(start_ms)
    # long % keeps the dividend's sign, so d - d % 60000 divides exactly
    return ((d - d % 60000) / 60000).cast("long")


def round_half_up(x, digits: int) -> Column:
    """``digits``-decimal rounding with ties toward +infinity (generalises java_round2)."""
    scale = float(10**digits)
    y = _c(x) * scale
    fl = F.floor(y)
    return (fl + F.when(y - fl >= 0.5, F.lit(1)).otherwise(F.lit(0))) / scale
