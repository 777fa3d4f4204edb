"""The registered queries: every operator of the inventory, run over the driver tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame. Double
columns are rounded to 3 decimals (ties up) so that results hash equally
across engines whose libm differs in the last bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotrail.config import EVENTS_PARAMS as P
from geotrail.functions.geo import round_half_up
from geotrail.operators import trips
from geotrail.operators.chunked import for_dense
from geotrail.operators.segments import BRIDGE_SEQ, fix_rows, run_segments, segment_table
from geotrail.plans import scenarios, views
from geotrail.plans.scenarios import RUN3_AS_OF_MS
from geotrail.sources import events, ingest

RECENT_N = 100  # the default page size of the latest-positions read


def r3(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            round_half_up(f.name, 3).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# ---- single run over all fixes: segments, rejections, alerts, roll-up -------------------------


def _segments(spark, sf_dir, positions=None):
    pos = positions if positions is not None else events.events_positions(spark, sf_dir)
    return segment_table(run_segments(fix_rows(pos), P))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 + X3: consecutive-fix segments per vehicle with their verdicts."""
    return r3(_segments(spark, sf_dir))


def haversine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Great-circle distance of every consecutive pair of fixes."""
    return r3(_segments(spark, sf_dir).select("vin", "from_ts", "to_ts", "distance_m"))


def segment_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speed of every segment (0 when no time elapsed)."""
    return r3(_segments(spark, sf_dir).select("vin", "to_ts", "dt_s", "speed_kph"))


def gps_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """segments rejected for speed above the anomaly threshold."""
    s = _segments(spark, sf_dir).filter(F.col("is_anomaly"))
    return r3(s.select("vin", "from_ts", "to_ts", "distance_m", "speed_kph"))


def position_jumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """jump rejections; they need zero elapsed time, so run on undeduped re-sends."""
    raw = ingest.normalize(events.events_positions_with_resends(spark, sf_dir))
    s = _segments(spark, sf_dir, raw).filter(F.col("is_jump"))
    return r3(s.select("vin", "from_ts", "to_ts", "distance_m", "dt_s"))


def speed_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """alerts of one run over all fixes."""
    from geotrail.operators.segments import alerts_from_segments

    pos = events.events_positions(spark, sf_dir)
    return r3(alerts_from_segments(run_segments(fix_rows(pos), P), P))


def trip_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 (flagship): one run over every vehicle's fixes -> its trip."""
    pos = events.events_positions(spark, sf_dir)
    return r3(trips.trip_rollup(pos, for_dense(pos, P)))


def running_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rounded running mean next to the plain mean of the same speeds."""
    pos = events.events_positions(spark, sf_dir)
    return r3(trips.running_average(pos, for_dense(pos, P)))


def stream_trip_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 stream form: the events table as a file stream through the keyed-state fold.

    One micro-batch from empty state is one run, so the open trips must equal
    the flagship roll-up. Outputs go to the shared checkpoint folder and are
    read back once the available data is processed.
    """
    from geotrail.sources.store import scratch_path
    from geotrail.streaming.stateful import open_trips, trip_stream, write_trip_stream

    root = scratch_path(spark, "stream")
    q = write_trip_stream(trip_stream(events.events_positions_stream(spark, sf_dir), P), f"{root}/out", f"{root}/ckpt")
    q.awaitTermination()
    return r3(open_trips(spark.read.parquet(f"{root}/out")))


def stream_ingest_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1 + I2 + S1 stream form: raw messages with re-sent copies -> open trips."""
    from geotrail.sources.store import scratch_path
    from geotrail.streaming.stateful import open_trips, trip_stream_from_raw

    root = scratch_path(spark, "stream")
    q = trip_stream_from_raw(events.events_raw_stream_with_resends(spark, sf_dir), f"{root}/out", f"{root}/ckpt", P)
    q.awaitTermination()
    return r3(open_trips(spark.read.parquet(f"{root}/out")))


def stream_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I3 from the stream: every message's outcome, first arrivals told from copies by keyed state."""
    from geotrail.sources.store import scratch_path
    from geotrail.streaming.stateful import trip_stream_from_raw

    root = scratch_path(spark, "stream")
    q = trip_stream_from_raw(events.events_raw_stream_with_resends(spark, sf_dir), f"{root}/out", f"{root}/ckpt", P, outcomes=True)
    q.awaitTermination()
    out = spark.read.parquet(f"{root}/out").where(F.col("kind") == "outcome")
    return out.select("vin", "timestamp", "arrival_seq", F.col("saved").alias("success"), "message")


def stream_retry_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + F1 + W2 as a stream in retry mode: the fixes of run 1, then, after a restart, those that came late or
    later; the open trips equal those of two batch runs that read their leftovers again."""
    from geotrail.schema import CAR_POSITIONS
    from geotrail.sources.store import scratch_path
    from geotrail.streaming.snapshot import OpenTrips
    from geotrail.streaming.stateful import trip_stream, write_trip_stream

    root = scratch_path(spark, "stream")
    first, everything = events.events_run_split(spark, sf_dir)
    rest = everything.join(first.select("vin", "timestamp", "arrival_seq"), ["vin", "timestamp", "arrival_seq"], "left_anti")
    for fixes in (first, rest):
        fixes.select(*CAR_POSITIONS.fieldNames()).write.mode("append").parquet(f"{root}/in")
        # each start takes in what has come since as one micro-batch
        source = spark.readStream.schema(CAR_POSITIONS).parquet(f"{root}/in")
        write_trip_stream(trip_stream(source, P, retry=True), f"{root}/out", f"{root}/ckpt").awaitTermination()
    return r3(OpenTrips(spark, f"{root}/out").read())


# ---- ingest -----------------------------------------------------------------------------------


def ingest_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inbound messages flattened with wire defaults."""
    return r3(ingest.normalize(events.events_positions_raw(spark, sf_dir)))


def ingest_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First arrival per (vin, timestamp) among originals and re-sends."""
    return r3(ingest.dedupe(ingest.normalize(events.events_positions_with_resends(spark, sf_dir))))


def ingest_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved / duplicate-ignored per inbound message."""
    return ingest.ingest_outcomes(events.events_positions_with_resends(spark, sf_dir))


# ---- incremental runs -----------------------------------------------------------------------


def _chain(spark, sf_dir, upto=3):
    return scenarios.run_chain(spark, sf_dir, P, upto=upto)


def processed_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixes marked processed by the three runs over all events."""
    c = _chain(spark, sf_dir)
    marks = [r.processed.select("vin", "timestamp") for r in (c.run1, c.run2, c.run3)]
    return marks[0].unionByName(marks[1]).unionByName(marks[2])


def unprocessed_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """what run 2 reads -- fixes not yet processed."""
    p2 = _chain(spark, sf_dir, 1).positions2
    return r3(p2.filter(~F.col("processed")).select("vin", "timestamp", "latitude", "longitude"))


def late_discard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """run 2's unprocessed fixes at or before their open trip's last update."""
    from geotrail.plans.run import late_discard as ld

    c = _chain(spark, sf_dir, 1)
    rows = ld(c.positions2, c.run1.current_trips, P)
    return rows.filter(F.col("is_late")).select("vin", F.col("ts").alias("timestamp"))


def segments_with_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run 2's segments, the first one from the bridge (open trip's last point)."""
    s = _chain(spark, sf_dir, 2).run2.rows.filter(F.col("has_segment"))
    return r3(
        s.select(
            "vin",
            F.col("prev.ts").alias("from_ts"),
            F.col("ts").alias("to_ts"),
            (F.col("prev.seq") == F.lit(BRIDGE_SEQ)).alias("from_bridge"),
            F.col("seg_m").alias("distance_m"),
            F.col("seg_kph").alias("speed_kph"),
            (F.col("accepted") == 1).alias("accepted"),
        )
    )


def run_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rows per vehicle after late discard (bridge included) and the gate verdict."""
    t = _chain(spark, sf_dir, 2).run2.trips
    return t.select("vin", F.col("n_rows").alias("kept_rows"), (F.col("n_rows") >= 2).alias("gated_in"))


def run_current_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + I5: open trips after run 2."""
    return r3(_chain(spark, sf_dir, 2).run2.current_trips)


def run_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + I7: alerts raised by runs 1 and 2."""
    c = _chain(spark, sf_dir, 2)
    return r3(c.run1.speed_alerts.unionByName(c.run2.speed_alerts))


def trip_timeouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run 3 (no new fixes) closes every trip idle longer than the timeout."""
    t = _chain(spark, sf_dir).run3.trips.filter(F.col("status") == "completed")
    return t.select(
        "vin",
        "last_update_timestamp",
        (F.lit(RUN3_AS_OF_MS) - F.col("last_update_timestamp")).alias("idle_ms"),
    )


def run_completed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 + I6: trips completed by run 3."""
    return r3(_chain(spark, sf_dir).run3.completed_trips)


# ---- history split into trips, and the read views ----------------------------------------------


def trip_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole history split into trips at gaps above the timeout."""
    pos = events.events_positions(spark, sf_dir)
    return r3(trips.trip_segmentation(pos, for_dense(pos, P), scenarios.HISTORY_AS_OF_MS))


def _store(spark, sf_dir):
    return scenarios.history_store(spark, sf_dir, P)


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1."""
    return views.vehicles(_store(spark, sf_dir).positions)


def current_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8 over the fleet."""
    return r3(views.current_trip(_store(spark, sf_dir).current_trips))


def completed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 over the fleet."""
    return r3(views.completed_trips(_store(spark, sf_dir).completed_trips))


def alerts_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 over the fleet."""
    return r3(views.alerts_recent(_store(spark, sf_dir).speed_alerts))


def recent_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest fixes per vehicle (a top-k report)."""
    p = events.events_positions(spark, sf_dir)
    return r3(views.recent_positions(p, RECENT_N).select("vin", "timestamp", "latitude", "longitude", "rank"))


def alert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4."""
    return views.alert_counts(_store(spark, sf_dir).speed_alerts)


def trip_stats_by_vin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5."""
    return r3(views.trip_stats_by_vin(_store(spark, sf_dir).completed_trips))


def vehicle_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 (the open trip flattened to ``current_*`` columns for comparison)."""
    s = _store(spark, sf_dir)
    v = views.vehicle_summary(s.positions, s.current_trips, s.completed_trips, s.speed_alerts, s.last_computed_at)
    flat = [F.col(f"current_trip.{c}").alias(f"current_{c}") for c in ("trip_start_timestamp", "last_update_timestamp", "total_distance_meters", "total_readings")]
    return r3(v.select(*[c for c in v.columns if c != "current_trip"], *flat))


def fleet_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 + A2 + A3 + S5."""
    s = _store(spark, sf_dir)
    return views.fleet_summary(s.positions, s.current_trips, s.completed_trips, s.speed_alerts, s.last_computed_at)


# ---- the same reads from a store that is kept up to date --------------------------------------------


def _filled_store(spark, sf_dir, runs=True):
    """A store that takes the fixes of run 1, then all that came late or later, with the three runs in between."""
    from geotrail.sources.store import TripStore, scratch_path

    store = TripStore(spark, scratch_path(spark, "store"))
    first, everything = events.events_run_split(spark, sf_dir)
    for fixes, as_of in ((first, scenarios.RUN1_AS_OF_MS), (everything, scenarios.RUN2_AS_OF_MS)):
        store.append_positions(fixes)  # what is stored already is ignored (I2)
        if runs:
            store.run(as_of, P)
    if runs:
        store.run(RUN3_AS_OF_MS, P)
    return store


def store_fleet_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 + A2 + A3 from what each append and run has counted."""
    return _filled_store(spark, sf_dir).fleet_summary()


def store_vehicle_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 + A4 + A5 from the runs' own totals (after run 3 no trip is open)."""
    return r3(_filled_store(spark, sf_dir).vehicle_summary().drop("current_trip"))


def store_recent_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 over stored fixes: only the dates that hold a vehicle's latest fixes are read."""
    p = _filled_store(spark, sf_dir, runs=False).recent_positions(RECENT_N)
    return r3(p.select("vin", "timestamp", "latitude", "longitude", "rank"))


def store_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 kept up to date over two appends, the second with late fixes between the first one's."""
    from geotrail.sources.history import TripHistory
    from geotrail.sources.store import TripStore, scratch_path

    store = TripStore(spark, scratch_path(spark, "store"))
    history = TripHistory(store, P)
    for fixes in events.events_run_split(spark, sf_dir):
        store.append_positions(fixes)
        history.extend()
    return r3(history.read(scenarios.HISTORY_AS_OF_MS))


def unknown_vins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vehicles of the customer registry (VIN of each customer key) without fixes."""
    reg = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.format_string("VIN%06d", F.col("c_custkey")).alias("vin")
    )
    return views.unknown_vins(reg, events.events_positions(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in [
        trip_rollup,
        stream_trip_rollup,
        stream_ingest_rollup,
        stream_outcomes,
        stream_retry_trips,
        haversine,
        segment_speed,
        segments,
        gps_anomalies,
        position_jumps,
        speed_alerts,
        running_average,
        ingest_normalize,
        ingest_dedupe,
        ingest_outcomes,
        processed_flags,
        unprocessed_positions,
        late_discard,
        segments_with_bridge,
        run_gate,
        run_current_trips,
        run_alerts,
        trip_timeouts,
        run_completed_trips,
        trip_segmentation,
        vehicles,
        current_trip,
        completed_trips,
        alerts_recent,
        recent_positions,
        alert_counts,
        trip_stats_by_vin,
        vehicle_summary,
        fleet_summary,
        store_fleet_summary,
        store_vehicle_summary,
        store_recent_positions,
        store_history,
        unknown_vins,
    ]
}
