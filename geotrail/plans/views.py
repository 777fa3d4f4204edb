"""Read queries over the trip tables.

The reference answers these for one vehicle at a time; here each is the
same question over the whole fleet with an optional ``vins`` filter, which
Catalyst pushes into the Parquet scans.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from geotrail.config import POSITIONS_PAGE_SIZE
from geotrail.schema import CURRENT_TRIP_COLUMNS


def _only(df: DataFrame, vins: Iterable[str] | None) -> DataFrame:
    return df if vins is None else df.filter(F.col("vin").isin(list(vins)))


def vehicles(positions: DataFrame) -> DataFrame:
    """A1: distinct vehicles with stored fixes (two-phase hash aggregate)."""
    return positions.select("vin").distinct()


def current_trip(current_trips: DataFrame, vins: Iterable[str] | None = None) -> DataFrame:
    """F8: the open trip per vehicle; a vehicle without one has no row (not found)."""
    return _only(current_trips, vins).select(*CURRENT_TRIP_COLUMNS)


def completed_trips(completed: DataFrame, vins: Iterable[str] | None = None) -> DataFrame:
    """Completed trips, newest start first per vehicle."""
    return _only(completed, vins).orderBy(F.col("vin"), F.col("trip_start_timestamp").desc())


def alerts_recent(alerts: DataFrame, vins: Iterable[str] | None = None) -> DataFrame:
    """Speed alerts, newest first per vehicle."""
    return _only(alerts, vins).orderBy(F.col("vin"), F.col("timestamp").desc())


def recent_positions(positions: DataFrame, n: int = POSITIONS_PAGE_SIZE, vins: Iterable[str] | None = None) -> DataFrame:
    """Latest ``n`` fixes per vehicle, newest first.

    ``row_number() <= n`` plans as a window group limit: each map task keeps
    at most ``n`` rows per vehicle before the shuffle, so a busy vehicle sends
    ``n`` rows per task, not all of its history.
    """
    if n < 1:
        raise ValueError("page size must be at least 1")
    w = Window.partitionBy("vin").orderBy(F.col("timestamp").desc())
    return (
        _only(positions, vins)
        .withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= n)
    )


def alert_counts(alerts: DataFrame) -> DataFrame:
    """A4: alerts per vehicle."""
    return alerts.groupBy("vin").agg(F.count(F.lit(1)).alias("speed_alerts_count"))


def trip_stats_by_vin(completed: DataFrame) -> DataFrame:
    """A5: completed-trip count, distance sum and *unweighted* mean of trip means.

    Trip means have two decimals; they are added as whole millionths and divided once, so the
    mean does not depend on the order of addition (plain sums of doubles do, and the third decimal of such a
    mean is often a tie).
    """
    micro = F.sum(F.round(F.col("average_speed_kph") * 1e6).cast("decimal(28,0)")).cast("double")
    return completed.groupBy("vin").agg(
        F.count(F.lit(1)).alias("completed_trips_count"),
        F.sum("total_distance_meters").alias("total_distance_meters"),
        (micro / (F.count("average_speed_kph") * F.lit(1e6))).alias("average_speed_kph"),
    )


def unknown_vins(requested: DataFrame, positions: DataFrame) -> DataFrame:
    """requested vehicles without any stored fix (the not-found answers).

    The fixes side is reduced to distinct vehicles first (combined map-side),
    so a vehicle with billions of fixes contributes one row per task to the
    join's shuffle rather than all of them.
    """
    return requested.select("vin").distinct().join(vehicles(positions), "vin", "left_anti")


def known_vins(requested: DataFrame, positions: DataFrame) -> DataFrame:
    """requested vehicles that exist."""
    return requested.select("vin").distinct().join(vehicles(positions), "vin", "left_semi")


def _trip_struct(prefix: str = "") -> Column:
    return F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in CURRENT_TRIP_COLUMNS])


def vehicle_summary(
    positions: DataFrame,
    current_trips: DataFrame,
    completed: DataFrame,
    alerts: DataFrame,
    last_computed_at: int,
    vins: Iterable[str] | None = None,
) -> DataFrame:
    """Per vehicle -- open trip, completed-trip stats, alert count, run time.

    Each side is aggregated to one row per vehicle before the joins, so the
    joins are one-to-one. A vehicle without completed trips gets distance
    0.0, mean NULL and count 0 (the reference fails there).
    """
    stats = trip_stats_by_vin(_only(completed, vins))
    totals = stats.join(alert_counts(_only(alerts, vins)), "vin", "full")
    return summary_of_vehicles(vehicles(positions), current_trips, totals, last_computed_at, vins)


def summary_of_vehicles(
    known: DataFrame, current_trips: DataFrame, totals: DataFrame, last_computed_at: int | None, vins: Iterable[str] | None = None
) -> DataFrame:
    """J2 from one row per vehicle on each side: the vehicles, their open trips, and their totals."""
    cur = _only(current_trips, vins).select("vin", _trip_struct().alias("current_trip"))
    return (
        _only(known, vins).join(cur, "vin", "left")
        .join(_only(totals, vins), "vin", "left")
        .select(
            "vin",
            "current_trip",
            F.coalesce(F.col("completed_trips_count"), F.lit(0)).cast("long").alias("completed_trips_count"),
            F.coalesce(F.col("total_distance_meters"), F.lit(0.0)).alias("total_distance_meters"),
            F.col("average_speed_kph"),
            F.coalesce(F.col("speed_alerts_count"), F.lit(0)).cast("long").alias("speed_alerts_count"),
            F.lit(last_computed_at).cast("long").alias("last_computed_at"),
        )
    )


def newest_dates(days: DataFrame, n: int) -> DataFrame:
    """``vin, event_date`` of the dates that hold each vehicle's latest ``n`` fixes, from counts per vehicle and date.

    A date is needed if the later dates together hold fewer than ``n``.
    """
    if n < 1:
        raise ValueError("page size must be at least 1")
    per_day = days.groupBy("vin", "event_date").agg(F.sum("n").alias("n"))  # a date may come in several appends
    later = Window.partitionBy("vin").orderBy(F.col("event_date").desc()).rowsBetween(Window.unboundedPreceding, -1)
    return per_day.withColumn("later", F.coalesce(F.sum("n").over(later), F.lit(0))).where(F.col("later") < n).select("vin", "event_date")


def fleet_summary(
    positions: DataFrame,
    current_trips: DataFrame,
    completed: DataFrame,
    alerts: DataFrame,
    last_computed_at: int,
) -> DataFrame:
    """Four independent fleet-wide counts in one row (exact distinct VIN count).

    Each count is a one-row global aggregate; they are stacked and folded
    into one row instead of cross-joined.
    """
    names = ["total_vehicles", "active_trips", "completed_trips", "total_speed_alerts"]
    parts = [
        positions.agg(F.countDistinct("vin").alias("_v")).withColumn("_k", F.lit(0)),
        current_trips.agg(F.count(F.lit(1)).alias("_v")).withColumn("_k", F.lit(1)),
        completed.agg(F.count(F.lit(1)).alias("_v")).withColumn("_k", F.lit(2)),
        alerts.agg(F.count(F.lit(1)).alias("_v")).withColumn("_k", F.lit(3)),
    ]
    stacked = parts[0]
    for q in parts[1:]:
        stacked = stacked.unionByName(q)
    return stacked.agg(
        *[F.max(F.when(F.col("_k") == i, F.col("_v"))).cast("long").alias(n) for i, n in enumerate(names)]
    ).withColumn("last_computed_at", F.lit(int(last_computed_at)).cast("long"))
