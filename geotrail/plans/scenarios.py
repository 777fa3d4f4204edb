"""Trip tables derived from the driver's ``events`` table.

* ``history_store``: the whole history split into trips (S6); closed trips,
  the open ones and the alerts of all in-trip segments.
* ``run_chain``: the incremental run three times -- run 1 sees the first
  half minus every 13th event, run 2 everything (those events arrive late),
  run 3 a month later with no new fixes, so every open trip times out.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geotrail.config import EVENTS_AS_OF_MS, EVENTS_PARAMS, HISTORY_AS_OF_MS, Params
from geotrail.operators import trips
from geotrail.operators.chunked import for_dense
from geotrail.plans.run import RunResult, apply_processed, multiplexed, run_batch, split_multiplexed
from geotrail.schema import CURRENT_TRIPS, empty
from geotrail.sources import events
from geotrail.sources.store import persist, scratch_path

RUN1_AS_OF_MS = 1_705_363_200_000  # 2024-01-16T00:00:00Z
RUN2_AS_OF_MS = EVENTS_AS_OF_MS    # 2024-02-01T00:00:00Z
RUN3_AS_OF_MS = 1_709_251_200_000  # 2024-03-01T00:00:00Z


@dataclass
class Store:
    positions: DataFrame
    current_trips: DataFrame
    completed_trips: DataFrame
    speed_alerts: DataFrame
    last_computed_at: int


def history_store(spark: SparkSession, sf_dir: str, p: Params = EVENTS_PARAMS) -> Store:
    pos = events.events_positions(spark, sf_dir)
    alerts, t = trips.history(pos, p, HISTORY_AS_OF_MS)
    current = t.filter(F.col("is_open")).select(
        "vin",
        "trip_start_timestamp",
        F.col("trip_end_timestamp").alias("last_update_timestamp"),
        "start_lat",
        "start_lon",
        F.col("end_lat").alias("last_lat"),
        F.col("end_lon").alias("last_lon"),
        "total_distance_meters",
        "average_speed_kph",
        "max_speed_kph",
        "total_readings",
    )
    completed = t.filter(~F.col("is_open")).drop("is_open", "trip_no")
    return Store(pos, current, completed, alerts, HISTORY_AS_OF_MS)


@dataclass
class Chain:
    run1: RunResult
    run2: RunResult | None
    run3: RunResult | None
    positions2: DataFrame        # run 2's input (run-1 marks applied)
    positions3: DataFrame | None  # run 3's input


def _persisted(r: RunResult, base: str, k: int) -> RunResult:
    """Write the run's outputs in one job and continue from the written tables."""
    written = persist(multiplexed(r), f"{base}/run{k}")
    parts = split_multiplexed(written, r)
    return replace(
        r,
        current_trips=parts["current_trips"],
        completed_trips=parts["completed_trips"],
        speed_alerts=parts["speed_alerts"],
        processed=parts["processed"],
    )


def run_chain(spark: SparkSession, sf_dir: str, p: Params = EVENTS_PARAMS, upto: int = 3) -> Chain:
    """Runs 1..``upto``. A run that feeds a later run has its outputs written to the
    shared checkpoint folder and read back, as the next run would read them from
    the store; the last run stays lazy."""
    base = scratch_path(spark, "chain")
    first, everything = events.events_run_split(spark, sf_dir)
    p = for_dense(everything, p)
    r1 = run_batch(first, empty(spark, CURRENT_TRIPS), RUN1_AS_OF_MS, p)
    r2 = r3 = pos3 = None
    if upto >= 2:
        r1 = _persisted(r1, base, 1)
    pos2 = apply_processed(everything, r1.processed)
    if upto >= 2:
        r2 = run_batch(pos2, r1.current_trips, RUN2_AS_OF_MS, p)
    if upto >= 3:
        r2 = _persisted(r2, base, 2)
        pos3 = apply_processed(everything, r1.processed.unionByName(r2.processed))
        r3 = run_batch(pos3, r2.current_trips, RUN3_AS_OF_MS, p)
    return Chain(r1, r2, r3, pos2, pos3)
