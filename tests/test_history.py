"""Trip split of a whole history (S6), the one-run property, chunk invariance and the fold horizon."""

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from geotrail.config import EVENTS_PARAMS, HISTORY_AS_OF_MS, Params
from geotrail.operators import chunked, pieces, trips
from geotrail.operators.segments import fix_rows, measured, run_segments
from geotrail.plans.run import run_batch
from geotrail.schema import CAR_POSITIONS, CURRENT_TRIPS, empty
from geotrail.sources import events
from tests.helpers import Fleet, k

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def same_rows(a, b, rel=1e-12):
    """Row-wise equality; doubles to a relative tolerance (sum order follows partitioning)."""
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            if isinstance(u, float):
                assert u == pytest.approx(v, rel=rel, abs=1e-9)
            else:
                assert u == v
    return True


def _positions(spark, fixes, vin="VIN000001"):
    data = [(vin, t, lat, lon, 0.0, 0.0, 0.0, "", False, i) for i, (t, lat, lon) in enumerate(fixes)]
    return spark.createDataFrame(data, CAR_POSITIONS)


def test_g8_history_split_gives_two_trips(spark):
    pos = _positions(spark, [k(0, 0), k(1, 1000), k(2, 3_600_000), k(3, 3_601_000)])
    t = trips.trip_segmentation(pos, Params(), 3_602_000).orderBy("trip_no").collect()
    assert [(r.trip_start_timestamp, r.trip_end_timestamp, r.total_readings, r.is_open) for r in t] == [
        (0, 1000, 1, False),
        (3_600_000, 3_601_000, 1, True),
    ]
    assert [r.average_speed_kph for r in t] == [40.03, 40.03]


def test_history_gap_boundary_is_strict(spark):
    # a gap equal to the timeout does not split (session windows would)
    pos = _positions(spark, [k(0, 0), k(1, 300_000), k(2, 600_001)])
    t = trips.trip_segmentation(pos, Params(), 10**9).orderBy("trip_no").collect()
    assert [(r.trip_start_timestamp, r.trip_end_timestamp) for r in t] == [(0, 300_000)]


def test_one_run_equals_history_without_gaps(spark):
    """Property: one run from empty state = roll-up with no gap split."""
    pos = events.events_positions(spark, SF)
    p = EVENTS_PARAMS
    res = run_batch(pos, empty(spark, CURRENT_TRIPS), HISTORY_AS_OF_MS, p)
    assert same_rows(rows(res.current_trips), rows(trips.trip_rollup(pos, p)))
    assert res.completed_trips.count() == 0


@pytest.mark.parametrize("chunk_ms", [1, 60_000, 86_400_000 * 400])
def test_chunk_width_invariance_on_driver_data(spark, chunk_ms):
    pos = events.events_positions(spark, SF)
    base = EVENTS_PARAMS
    other = EVENTS_PARAMS.with_(chunk_ms=chunk_ms)
    assert same_rows(
        rows(trips.trip_segmentation(pos, other, HISTORY_AS_OF_MS)), rows(trips.trip_segmentation(pos, base, HISTORY_AS_OF_MS))
    )
    assert same_rows(rows(trips.trip_rollup(pos, other)), rows(trips.trip_rollup(pos, base)))


def _py_fold(speeds):
    n, avg = 0, 0.0
    for v in speeds:
        n += 1
        y = (avg * (n - 1) + v) / n * 100.0
        f = math.floor(y)
        avg = (f + (1 if y - f >= 0.5 else 0)) / 100.0
    return avg


def test_fold_horizon_is_exact(spark):
    """With anomalies above 2 kph the mean freezes after 401 readings; folding only
    those gives the full fold's answer on a 3000-segment trip spread over chunks."""
    p = Params(anomaly_speed_kph=2.0, chunk_ms=200_000)
    assert p.fold_horizon == 401
    rnd = random.Random(3)
    fixes, lat, t = [], 30.0, 0
    for i in range(3001):
        fixes.append((t, lat, -97.0))
        t += 1000
        lat += rnd.uniform(0.0, 0.000004)  # up to ~1.6 kph
    pos = _positions(spark, fixes)
    segs = run_segments(fix_rows(pos), p).filter(F.col("accepted") == 1).orderBy("ts").select("seg_kph").collect()
    speeds = [r.seg_kph for r in segs]
    assert len(speeds) == 3000 and max(speeds) <= 2.0
    got = trips.trip_rollup(pos, p).collect()[0]
    assert got.total_readings == 3000
    assert got.average_speed_kph == _py_fold(speeds)
    # and the freeze really happens: the tail cannot move the mean
    assert _py_fold(speeds[:401]) == _py_fold(speeds)


def test_fleet_helper_runs_are_deterministic(spark):
    f = Fleet(spark)
    f.send(k(0, 1000), k(1, 2000), k(3, 3000))
    f.run(4000)
    assert f.trip()["total_readings"] == 2


@pytest.mark.parametrize("chunk_ms", [1, 3_600_000, 86_400_000, 86_400_000 * 400])
@pytest.mark.parametrize("block", [1, 3, 1024])
def test_pieces_know_what_comes_before(spark, chunk_ms, block):
    """Trip numbers, readings and sums before each piece = plain windows over the whole vehicle."""
    pos = events.events_positions(spark, SF)
    p = Params(trip_timeout_ms=6 * 3_600_000, chunk_ms=chunk_ms, fold_block=block)  # many breaks inside and between chunks
    rows = chunked.with_previous(chunked.add_chunk(fix_rows(pos), p))
    got = pieces.placed(pieces.chunk_pieces(rows, p, p.trip_timeout_ms), p, p.trip_timeout_ms)
    got = got.select("vin", F.col("first.ts").alias("ts"), F.col("first.seq").alias("seq"), "trip_no", "n0", "acc_n", "kph0", F.size("v").alias("held"))
    w = Window.partitionBy("vin").orderBy("ts", "seq")
    plain = fix_rows(pos).withColumn("prev", F.lag(chunked.point()).over(w))
    gap = F.coalesce(F.col("ts") - F.col("prev.ts") > p.trip_timeout_ms, F.lit(False))
    plain = measured(plain.withColumn("gap", gap), p, F.col("prev").isNotNull() & ~gap)
    plain = plain.withColumn("trip", F.sum(F.col("gap").cast("int")).over(w))
    before = Window.partitionBy("vin", "trip").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, -1)
    plain = plain.select(
        "vin", "ts", "seq", "trip", F.coalesce(F.sum("accepted").over(before), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(F.col("accepted") == 1, F.col("seg_kph"))).over(before), F.lit(0.0)).alias("kph"),
    )
    both = got.join(plain, ["vin", "ts", "seq"]).collect()
    assert len(both) == got.count()
    for r in both:
        # a piece that opens its chunk holds the reading of its own first row
        assert (r.trip_no, r.n0) == (r.trip, r.n) and r.kph0 == pytest.approx(r.kph, rel=1e-9, abs=1e-9)
        assert r.held == r.acc_n <= block + 1
    assert len({r.trip_no for r in both}) > 5


def test_one_vehicle_spreads_over_tasks(spark):
    """All rows of one vehicle (a hot key) land in many partitions after the row shuffle."""
    fixes = [k(i % 50, i * 60_000) for i in range(2000)]  # 2000 fixes over ~33 hours
    pos = _positions(spark, fixes)
    rows = chunked.with_halo(chunked.add_chunk(fix_rows(pos), Params(chunk_ms=3_600_000)))
    key = "spark.sql.adaptive.coalescePartitions.enabled"  # AQE would merge a tiny shuffle into one task
    spark.conf.set(key, "false")
    try:
        parts = rows.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set(key, "true")
    assert parts >= 4
    # and the answer is the same as with everything in one chunk
    one = trips.trip_rollup(pos, Params(chunk_ms=10**13)).collect()
    many = trips.trip_rollup(pos, Params(chunk_ms=3_600_000)).collect()
    assert same_rows([tuple(r) for r in one], [tuple(r) for r in many])
