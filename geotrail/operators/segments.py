"""Segments between consecutive fixes (W1), bridge rows (W3), GPS rejections (F3, F4), alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotrail.config import Params
from geotrail.functions.geo import dt_seconds, haversine_m, java_round2, speed_kph
from geotrail.operators import chunked

def fix_rows(positions: DataFrame) -> DataFrame:
    """Stored fixes in the row contract of :mod:`chunked` (not bridge rows)."""
    seq = F.col("arrival_seq") if "arrival_seq" in positions.columns else F.lit(0).cast("long")
    return positions.select(
        F.col("vin"),
        F.col("timestamp").alias("ts"),
        seq.cast("long").alias("seq"),
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"),
        F.lit(False).alias("is_bridge"),
    )


# A bridge row sorts after every fix with its timestamp: fixes at or before
# the open trip's last update (late ones) are then exactly those before it.
BRIDGE_SEQ = 9223372036854775807


def bridge_rows(current_trips: DataFrame) -> DataFrame:
    """Each open trip's last accepted point as a leading, already-processed fix."""
    return current_trips.select(
        F.col("vin"),
        F.col("last_update_timestamp").alias("ts"),
        F.lit(BRIDGE_SEQ).cast("long").alias("seq"),
        F.col("last_lat").alias("lat"),
        F.col("last_lon").alias("lon"),
        F.lit(True).alias("is_bridge"),
    )


def seed_table(current_trips: DataFrame) -> DataFrame:
    """The open trips' running totals, one row per vehicle, that seed the roll-up.

    They join pieces, the per-chunk summary and the per-trip result, never the rows.
    """
    return current_trips.select(
        F.col("vin"),
        F.col("trip_start_timestamp").alias("seed_start_ts"),
        F.col("start_lat").alias("seed_start_lat"),
        F.col("start_lon").alias("seed_start_lon"),
        F.col("total_distance_meters").alias("seed_distance"),
        F.col("average_speed_kph").alias("seed_avg"),
        F.col("max_speed_kph").alias("seed_max"),
        F.col("total_readings").cast("long").alias("seed_n"),
    )


def _rejections(dist: Column, kph: Column, dt: Column, p: Params) -> tuple[Column, Column]:
    anomaly = kph > F.lit(p.anomaly_speed_kph)  # NaN compares greater: rejected too
    jump = (~anomaly) & (dist > F.lit(p.jump_distance_m)) & (dt < F.lit(p.jump_window_s))
    return anomaly, jump


def measured(rows: DataFrame, p: Params, has_seg: Column | None = None) -> DataFrame:
    """Measure and judge the segment from ``prev`` to each row (default: wherever there is a ``prev``)."""
    prev = F.col("prev")
    has_seg = prev.isNotNull() if has_seg is None else has_seg
    d = rows.withColumn("seg_m", haversine_m(prev["lat"], prev["lon"], "lat", "lon", p.earth_radius_m))
    d = d.withColumn("seg_dt_s", dt_seconds(prev["ts"], F.col("ts")))
    d = d.withColumn("seg_kph", speed_kph(F.col("seg_m"), prev["ts"], F.col("ts")))
    anomaly, jump = _rejections(F.col("seg_m"), F.col("seg_kph"), F.col("seg_dt_s"), p)
    d = d.withColumn("has_segment", has_seg)
    d = d.withColumn("is_anomaly", has_seg & anomaly).withColumn("is_jump", has_seg & jump)
    return d.withColumn("accepted", (has_seg & ~anomaly & ~jump).cast("int"))


def run_segments(rows: DataFrame, p: Params) -> DataFrame:
    """The segments of one run over all rows, one row each, without trip context."""
    return measured(chunked.pairs(chunked.add_chunk(rows, p)), p).withColumn("is_bridge", F.lit(False))


def trip_segments(rows: DataFrame, p: Params, gap_ms: int) -> DataFrame:
    """The segments inside trips: those that span no gap above ``gap_ms``."""
    pairs = chunked.pairs(chunked.add_chunk(rows, p))
    return measured(pairs.where(F.col("ts") - F.col("prev.ts") <= F.lit(gap_ms)), p).withColumn("is_bridge", F.lit(False))


def next_accepted(p: Params) -> Column:
    """The segment to the ``next`` fix passes both rejection rules (null without one)."""
    nxt = F.col("next")
    m = haversine_m("lat", "lon", nxt["lat"], nxt["lon"], p.earth_radius_m)
    kph = speed_kph(m, F.col("ts"), nxt["ts"])
    anomaly, jump = _rejections(m, kph, dt_seconds(F.col("ts"), nxt["ts"]), p)
    return F.when(nxt.isNotNull(), ~anomaly & ~jump)


def is_alert(p: Params) -> Column:
    """An accepted segment faster than the limit (a bridge row ends none)."""
    return (F.col("accepted") == 1) & (F.col("seg_kph") > F.lit(p.speed_limit_kph)) & ~F.col("is_bridge")


def alerts_from_segments(segs: DataFrame, p: Params) -> DataFrame:
    """Speed alerts: accepted segments faster than the limit, at the segment's end fix."""
    return segs.filter(is_alert(p)).select(
        "vin",
        F.col("ts").alias("timestamp"),
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        java_round2(F.col("seg_kph")).alias("computed_speed_kph"),
        F.lit(float(p.speed_limit_kph)).alias("speed_limit_kph"),
    )


def segment_table(segs: DataFrame) -> DataFrame:
    """Public shape of a segment: from / to fix, distance, time, speed, verdicts."""
    return segs.filter(F.col("has_segment")).select(
        "vin",
        F.col("prev.ts").alias("from_ts"),
        F.col("ts").alias("to_ts"),
        F.col("prev.lat").alias("from_lat"),
        F.col("prev.lon").alias("from_lon"),
        F.col("lat").alias("to_lat"),
        F.col("lon").alias("to_lon"),
        F.col("seg_m").alias("distance_m"),
        F.col("seg_dt_s").alias("dt_s"),
        F.col("seg_kph").alias("speed_kph"),
        "is_anomaly",
        "is_jump",
        (F.col("accepted") == 1).alias("accepted"),
    )
