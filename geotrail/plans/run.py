"""One incremental analytics run over all vehicles (S1-S3 with F1, F2, F6, W2, W3).

``run_batch(positions, current_trips, as_of_ms)`` is a pure function of the
stored fixes (with their ``processed`` flags), the open trips and the run's
clock. Per vehicle it reproduces the reference's run:

* unprocessed fixes (F1) at or before the open trip's last update are late
  and ignored (F2); the open trip's last point is prepended as a bridge (W3);
* fewer than two rows left -> no segments; an open trip then closes when
  ``as_of_ms - last update > timeout`` (F6, S2, S3);
* otherwise consecutive rows form segments, rejected ones skip (F3, F4),
  accepted ones extend the trip and may raise alerts (A6-A11, F5); a fix
  becomes processed when it starts an accepted segment or is the last (W2).

All vehicles run in one plan: fixes and bridge rows are shuffled once on
``(vin, time chunk)``, together with one halo row per chunk that brings its neighbours, the bridge and the
gate (:func:`geotrail.operators.chunked.with_halo`); no row is joined to anything and no vehicle is
confined to a task. The roll-up reduces the same rows to pieces (:mod:`geotrail.operators.pieces`).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotrail.config import DEFAULT, Params
from geotrail.functions.geo import duration_minutes, java_round2
from geotrail.operators import chunked, pieces
from geotrail.operators.segments import alerts_from_segments, bridge_rows, fix_rows, is_alert, measured, next_accepted, seed_table
from geotrail.operators.trips import TRIP_COLUMNS, trip_columns
from geotrail.schema import COMPLETED_TRIP_COLUMNS


@dataclass
class RunResult:
    current_trips: DataFrame     # open trips after the run (full snapshot)
    completed_trips: DataFrame   # trips closed by this run (to append)
    speed_alerts: DataFrame      # alerts raised by this run (to append)
    processed: DataFrame         # (vin, timestamp, arrival_seq) of fixes this run marks processed
    rows: DataFrame              # per-row diagnostics: late discard, gate, segments
    trips: DataFrame             # per-vehicle outcome with its class
    row_outputs: DataFrame       # alerts and marks from one pass over the rows, told apart by ``kind``
    trip_outputs: DataFrame      # open and completed trips from one pass over the trips


def run_rows(positions: DataFrame, current_trips: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """A run's rows: unprocessed fixes (F1) and bridges (W3), each with its neighbours, whether it is late (F2)
    and whether its vehicle passes the gate (F6)."""
    fixes = fix_rows(positions.filter(~F.col("processed")))
    rows = chunked.add_chunk(fixes.unionByName(bridge_rows(current_trips)), p)
    limit = pieces.horizon(p, F.col("average_speed_kph"))
    return chunked.with_halo(rows, current_trips.select("vin", limit.alias("horizon"))).withColumn(
        "horizon", F.coalesce(F.col("horizon"), pieces.horizon(p))
    )


def late_discard(positions: DataFrame, current_trips: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """F2 / J1 as a stand-alone query: a run's rows with ``is_late``."""
    return run_rows(positions, current_trips, p)


def run_batch(
    positions: DataFrame, current_trips: DataFrame, as_of_ms: int, p: Params = DEFAULT
) -> RunResult:
    seeds = seed_table(current_trips)
    rows = run_rows(positions, current_trips, p).filter(~F.col("is_late"))
    segs = measured(rows, p)
    parts = pieces.placed(pieces.chunk_pieces(rows, p), p, entered=True, seeds=seeds)
    t = trip_columns(pieces.trip_totals(parts, p), seeds)

    gated_in = F.col("n_rows") >= 2
    timed_out = ~gated_in & F.col("has_bridge") & (
        F.lit(as_of_ms) - F.col("last_update_timestamp") > F.lit(p.trip_timeout_ms)
    )
    status = (
        F.when(gated_in & F.col("has_bridge"), F.lit("updated"))
        .when(gated_in, F.lit("started"))
        .when(timed_out, F.lit("completed"))
        .when(F.col("has_bridge"), F.lit("open"))
        .otherwise(F.lit("waiting"))
    )
    t = t.withColumn("status", status)
    is_done = F.col("status") == "completed"
    current = t.filter(F.col("status").isin("updated", "started", "open")).select(*TRIP_COLUMNS)
    ends = {
        "trip_end_timestamp": "last_update_timestamp",
        "end_lat": "last_lat",
        "end_lon": "last_lon",
    }
    minutes = duration_minutes("trip_start_timestamp", "last_update_timestamp")
    completed = t.filter(is_done).select("*", *[F.col(c).alias(n) for n, c in ends.items()], minutes.alias("duration_minutes"))
    # a mark names one stored fix: (vin, timestamp) and its arrival (copies of a
    # key are told apart when the input was not deduplicated)
    is_mark = ~F.col("is_bridge") & F.col("gated_in") & (F.col("next").isNull() | next_accepted(p))
    marks = segs.filter(is_mark).select("vin", F.col("ts").alias("timestamp"), F.col("seq").alias("arrival_seq"))
    return RunResult(
        current_trips=current,
        completed_trips=completed.select(*COMPLETED_TRIP_COLUMNS),
        speed_alerts=alerts_from_segments(segs, p),
        processed=marks,
        rows=segs,
        trips=t,
        row_outputs=_row_outputs(segs, is_mark, p),
        trip_outputs=t.filter(F.col("status") != "waiting").select(
            F.when(is_done, F.lit("completed_trips")).otherwise(F.lit("current_trips")).alias("kind"),
            *TRIP_COLUMNS,
            *[F.when(is_done, F.col(c)).alias(n) for n, c in ends.items()],
            F.when(is_done, minutes).alias("duration_minutes"),
        ),
    )


def _row_outputs(segs: DataFrame, is_mark: Column, p: Params) -> DataFrame:
    """Each row's alert and mark, if any, exploded from one evaluation of the segments."""
    kinds = F.array_compact(F.array(F.when(is_alert(p), F.lit("speed_alerts")), F.when(is_mark, F.lit("processed"))))
    found = segs.withColumn("kind", F.explode(kinds))
    alert = F.col("kind") == "speed_alerts"
    return found.select(
        "kind",
        "vin",
        F.col("ts").alias("timestamp"),
        F.when(~alert, F.col("seq")).alias("arrival_seq"),
        F.when(alert, F.col("lat")).alias("latitude"),
        F.when(alert, F.col("lon")).alias("longitude"),
        F.when(alert, java_round2(F.col("seg_kph"))).alias("computed_speed_kph"),
        F.when(alert, F.lit(float(p.speed_limit_kph))).alias("speed_limit_kph"),
    )


OUTPUT_KINDS = ("current_trips", "completed_trips", "speed_alerts", "processed")


def _frames(result: RunResult) -> dict[str, DataFrame]:
    return {
        "current_trips": result.current_trips,
        "completed_trips": result.completed_trips,
        "speed_alerts": result.speed_alerts,
        "processed": result.processed,
    }


def multiplexed(result: RunResult) -> DataFrame:
    """All outputs of a run as one frame with a ``kind`` column.

    Writing this once lands every output of the run in the same job, so a
    run is committed whole or not at all; rows and trips are evaluated once each.
    """
    return result.row_outputs.unionByName(result.trip_outputs, allowMissingColumns=True)


def split_multiplexed(df: DataFrame, like: RunResult) -> dict[str, DataFrame]:
    """Inverse of :func:`multiplexed` (reads each kind with its own columns)."""
    src = _frames(like)
    return {k: df.filter(F.col("kind") == k).select(*src[k].columns) for k in src}


MARK_KEY = ["vin", "timestamp", "arrival_seq"]


def apply_processed(positions: DataFrame, marks: DataFrame) -> DataFrame:
    """Positions with processed marks applied (join on vin, timestamp and arrival)."""
    key = MARK_KEY if "arrival_seq" in positions.columns and "arrival_seq" in marks.columns else MARK_KEY[:2]
    m = marks.select(*key, F.lit(True).alias("_m")).distinct()
    return positions.join(m, key, "left").select(
        *[
            (F.col("processed") | F.coalesce(F.col("_m"), F.lit(False))).alias("processed") if c == "processed" else c
            for c in positions.columns
        ]
    )
