"""Trip roll-up (A6-A11) and history segmentation into trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from geotrail.config import Params
from geotrail.functions.fold import rounded_mean_fold, through_maps
from geotrail.functions.geo import duration_minutes, java_round2
from geotrail.operators import chunked, pieces
from geotrail.operators.segments import alerts_from_segments, fix_rows, trip_segments

TRIP_COLUMNS = [
    "vin",
    "trip_start_timestamp",
    "last_update_timestamp",
    "start_lat",
    "start_lon",
    "last_lat",
    "last_lon",
    "total_distance_meters",
    "average_speed_kph",
    "max_speed_kph",
    "total_readings",
]


SEED_NAMES = [
    "seed_start_ts",
    "seed_start_lat",
    "seed_start_lon",
    "seed_distance",
    "seed_avg",
    "seed_max",
    "seed_n",
]


def trip_columns(agg: DataFrame, seeds: DataFrame | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Apply the roll-up rules to the aggregates, seeded by the open trip (if any).

    ``seeds`` has one row per vehicle (see ``segments.seed_table``); the join
    is between two per-vehicle tables. ``keep`` names aggregates to hand on.
    """
    if seeds is not None:
        agg = agg.join(seeds, "vin", "left")
    else:
        agg = agg.select("*", *[F.lit(None).cast("long" if c in ("seed_start_ts", "seed_n") else "double").alias(c) for c in SEED_NAMES])
    first = F.col("first")
    last = F.coalesce(F.col("last_acc"), first)
    seed_n = F.coalesce(F.col("seed_n"), F.lit(0).cast("long"))
    seed_avg = F.coalesce(F.col("seed_avg"), F.lit(0.0))
    return agg.select(
        "vin",
        "trip_no",
        "n_rows",
        (F.col("has_bridge") == 1).alias("has_bridge"),
        F.coalesce(F.col("seed_start_ts"), first["ts"]).alias("trip_start_timestamp"),
        last["ts"].alias("last_update_timestamp"),
        F.coalesce(F.col("seed_start_lat"), first["lat"]).alias("start_lat"),
        F.coalesce(F.col("seed_start_lon"), first["lon"]).alias("start_lon"),
        last["lat"].alias("last_lat"),
        last["lon"].alias("last_lon"),
        (F.coalesce(F.col("seed_distance"), F.lit(0.0)) + F.coalesce(F.col("acc_m"), F.lit(0.0))).alias(
            "total_distance_meters"
        ),
        through_maps(rounded_mean_fold(F.col("speeds"), seed_n, seed_avg), F.col("maps")).alias("average_speed_kph"),
        F.greatest(
            F.coalesce(F.col("seed_max"), F.lit(0.0)), F.coalesce(java_round2(F.col("acc_max_kph")), F.lit(0.0))
        ).alias("max_speed_kph"),
        (seed_n + F.col("acc_n")).cast("int").alias("total_readings"),
        *keep,
    )


def trip_totals(positions: DataFrame, p: Params, gap_ms: int | None = None) -> DataFrame:
    """Totals per trip of all fixes, from empty state (see :func:`pieces.trip_totals`)."""
    rows = chunked.with_previous(chunked.add_chunk(fix_rows(positions), p))
    return pieces.trip_totals(pieces.placed(pieces.chunk_pieces(rows, p, gap_ms), p, gap_ms), p)


def trip_rollup(positions: DataFrame, p: Params) -> DataFrame:
    """All fixes of each vehicle folded as one run into one new trip.

    Vehicles with fewer than two fixes yield no trip (the run gate).
    """
    trips = trip_columns(trip_totals(positions, p))
    return trips.filter(F.col("n_rows") >= 2).select(*TRIP_COLUMNS)


def running_average(positions: DataFrame, p: Params) -> DataFrame:
    """A9 beside the plain mean of the same speeds (null without an accepted segment)."""
    agg = trip_totals(positions, p).withColumn(
        "plain_average_kph", F.when(F.col("acc_n") > 0, F.col("acc_kph") / F.col("acc_n"))
    )
    trips = trip_columns(agg, keep=("plain_average_kph",)).filter(F.col("n_rows") >= 2)
    return trips.select("vin", "total_readings", "average_speed_kph", "plain_average_kph")


def trip_segmentation(positions: DataFrame, p: Params, as_of_ms: int) -> DataFrame:
    """Split each vehicle's whole history into trips at gaps > ``trip_timeout_ms``.

    Each trip is rolled up like one run; trips of a single fix yield no row.
    The vehicle's last trip is open while ``as_of_ms - last update <= timeout``.
    """
    trips = trip_columns(trip_totals(positions, p, gap_ms=p.trip_timeout_ms))
    last_trip = F.max("trip_no").over(Window.partitionBy("vin"))
    t = trips.withColumn("_last", F.col("trip_no") == last_trip).filter(F.col("n_rows") >= 2)
    is_open = F.col("_last") & (F.lit(as_of_ms) - F.col("last_update_timestamp") <= F.lit(p.trip_timeout_ms))
    return t.select(
        "vin",
        "trip_no",
        "trip_start_timestamp",
        F.col("last_update_timestamp").alias("trip_end_timestamp"),
        "start_lat",
        "start_lon",
        F.col("last_lat").alias("end_lat"),
        F.col("last_lon").alias("end_lon"),
        "total_distance_meters",
        "average_speed_kph",
        "max_speed_kph",
        "total_readings",
        duration_minutes("trip_start_timestamp", "last_update_timestamp").alias("duration_minutes"),
        is_open.alias("is_open"),
    )


def history(positions: DataFrame, p: Params, as_of_ms: int) -> tuple[DataFrame, DataFrame]:
    """(alerts, trips) of the whole history; both read the one shuffle of the fixes."""
    return history_alerts(positions, p), trip_segmentation(positions, p, as_of_ms)


def history_alerts(positions: DataFrame, p: Params) -> DataFrame:
    """Speed alerts of the accepted in-trip segments of the whole history."""
    return alerts_from_segments(trip_segments(fix_rows(positions), p, p.trip_timeout_ms), p)
