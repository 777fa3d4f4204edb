"""The rounded mean as composed maps of its grid (A9/A11), and a vehicle that holds a third of all rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from geotrail.config import Params
from geotrail.functions import fold
from geotrail.operators import chunked, pieces, trips
from geotrail.operators.segments import fix_rows, run_segments
from geotrail.plans.run import run_batch
from geotrail.schema import CAR_POSITIONS, CURRENT_TRIPS, empty


def _fold(speeds, n=0, avg=0.0):
    means = []
    for v in speeds:
        y = (avg * n + v) / (n + 1) * 100.0
        n += 1
        f = math.floor(y)
        avg = (f + (1 if y - f >= 0.5 else 0)) / 100.0
        means.append(avg)
    return avg, means


def _speeds(kind, n, seed=1):
    rnd = random.Random(seed)
    if kind == "rising":
        return [300.0 * i / n for i in range(n)]
    if kind == "halves":  # every step a tie or next to one
        return [rnd.choice([0.005, 0.015, 299.995, 150.0]) for _ in range(n)]
    if kind == "sticking":  # the mean stays although the readings move away
        return [50.0] * (n // 2) + [54.0] * (n - n // 2)
    return [rnd.uniform(0, 300) for _ in range(n)]


@pytest.mark.parametrize("kind", ["random", "rising", "halves", "sticking"])
def test_possible_means_hold_the_mean(kind):
    speeds = _speeds(kind, 5000)
    _, means = _fold(speeds)
    for n in (1, 2, 10, 333, 2500, 5000):
        lo, hi = fold.possible_means(sum(speeds[:n]), n, 300.0)
        assert lo <= round(means[n - 1] * 100) <= hi
        assert hi - lo <= min(30_001, (n + 1) / 2 + 5)
    # an open trip's mean that rounding moved as far as it can
    for n, avg in ((500, 40.0), (60_000, 299.99)):
        lo, hi = fold.possible_means(n * avg, n, 300.0)
        assert lo <= round(avg * 100) <= hi and hi - lo <= 30_002


@pytest.mark.parametrize("kind", ["random", "rising", "halves", "sticking"])
def test_block_map_equals_fold_from_every_start(kind):
    speeds = _speeds(kind, 300)
    for n in (1, 7, 1000, 59_000):
        got = fold.block_map(np.array(speeds), n, 0, 30_000)
        assert len(got) == 30_001 and (np.diff(got) >= 0).all()
        for start in (0, 1, 4999, 12_345, 29_999, 30_000):
            assert got[start] / 100.0 == _fold(speeds, n, start / 100.0)[0]


def test_composition_is_associative():
    speeds = _speeds("random", 900)
    parts = [(i, fold.block_map(np.array(speeds[i : i + 300]), 50 + i, 0, 30_000)) for i in (0, 300, 600)]
    (_, a), (_, b), (_, c) = parts
    left = fold.composed(*fold.composed(0, a, 0, b), 0, c)
    right = fold.composed(0, a, *fold.composed(0, b, 0, c))
    assert (left[1] == right[1]).all()
    assert (left[1] == fold.block_map(np.array(speeds), 50, 0, 30_000)).all()


def _positions(spark, per_vin):
    data = [
        (vin, t, lat, -97.0, 0.0, 0.0, 0.0, "", False, i) for vin, fixes in per_vin.items() for i, (t, lat) in enumerate(fixes)
    ]
    return spark.createDataFrame(data, CAR_POSITIONS).repartition(6)


def _track(n, seed, step_ms=1000):
    rnd = random.Random(seed)
    out, lat, way = [], 30.0, 1
    for i in range(n):
        out.append((i * step_ms, lat))
        lat += way * rnd.uniform(0.0, 0.0006)  # up to some 240 km/h
        way = -way if abs(lat - 30.0) > 0.5 else way
    return out


def _accepted(pos, p, vin):
    s = run_segments(fix_rows(pos), p).filter((F.col("accepted") == 1) & (F.col("vin") == vin)).orderBy("ts")
    return [r.seg_kph for r in s.select("seg_kph").collect()]


@pytest.mark.parametrize("block,chunk_ms", [(64, 100_000), (1024, 3_600_000), (1024, 7_000), (200, 10**12)])
def test_hot_vehicle_folds_in_blocks(spark, block, chunk_ms):
    """A third of all rows in one vehicle: its mean comes from block maps, equals the fold, and no array is large."""
    tracks = {"HOT": _track(5000, 1), **{f"V{i}": _track(100, i + 2) for i in range(100)}}
    pos = _positions(spark, tracks)
    p = Params(chunk_ms=chunk_ms, fold_block=block)
    got = {r.vin: r for r in trips.trip_rollup(pos, p).collect()}
    assert len(got) == 101
    for vin in ("HOT", "V3", "V77"):
        speeds = _accepted(pos, p, vin)
        assert got[vin].total_readings == len(speeds)
        assert got[vin].average_speed_kph == _fold(speeds)[0]
    rows = chunked.with_previous(chunked.add_chunk(fix_rows(pos), p))
    placed = pieces.placed(pieces.chunk_pieces(rows, p), p)
    assert placed.agg(F.max(F.size("v"))).first()[0] <= block + 1
    sizes = pieces.trip_totals(placed, p).agg(
        F.max(F.size("speeds")).alias("s"), F.max(F.array_max(F.transform("maps", lambda m: F.size(m["map"])))).alias("m"),
        F.max(F.size("maps")).alias("n"),
    ).first()
    assert sizes.s <= 2 * block + 1 and sizes.m <= 30_001 and sizes.n >= 5000 // (2 * block) - 1


def test_speeds_after_the_horizon_stay_behind(spark):
    """With a horizon of 401 readings a vehicle's 3 000 readings shrink to it before they meet; the mean is the fold's."""
    fixes = []
    lat = 30.0
    rnd = random.Random(3)
    for i in range(3001):
        fixes.append((i * 1000, lat))
        lat += rnd.uniform(0.0, 0.000004)
    pos = _positions(spark, {"A": fixes})
    for block in (50, 1024):
        p = Params(anomaly_speed_kph=2.0, chunk_ms=60_000, fold_block=block)
        rows = chunked.with_previous(chunked.add_chunk(fix_rows(pos), p))
        held = pieces.placed(pieces.chunk_pieces(rows, p), p).agg(F.sum(F.size("v"))).first()[0]
        assert 401 <= held <= 401 + 2 * 60 + 51  # whole pieces and the segments that enter chunks
        assert trips.trip_rollup(pos, p).first().average_speed_kph == _fold(_accepted(pos, p, "A"))[0]


def test_trips_of_one_vehicle_fold_apart(spark):
    """Many long trips of one vehicle (S6): each restarts its count, in blocks of its own."""
    fixes, start = [], 0
    for trip in range(4):
        fixes += [(start + t, lat) for t, lat in _track(700 + 50 * trip, trip)]
        start = fixes[-1][0] + 400_000
    pos = _positions(spark, {"A": fixes})
    for chunk_ms in (50_000, 10**9):
        p = Params(chunk_ms=chunk_ms, fold_block=100)
        got = trips.trip_segmentation(pos, p, start).orderBy("trip_no").collect()
        assert [r.trip_no for r in got] == [0, 1, 2, 3]
        at = 0
        for trip, r in enumerate(got):
            part = fixes[at : at + 700 + 50 * trip]
            at += len(part)
            one = _positions(spark, {"A": part})
            speeds = _accepted(one, p, "A")
            assert (r.total_readings, r.average_speed_kph) == (len(speeds), _fold(speeds)[0])


def test_seeded_run_goes_on_folding(spark):
    """Two runs over halves of a track: the open trip's mean and count seed the second run's maps."""
    fixes = _track(4000, 9)
    p = Params(chunk_ms=300_000, fold_block=128)
    first, both = _positions(spark, {"A": fixes[:1500]}), _positions(spark, {"A": fixes[1500:]})
    r1 = run_batch(first, empty(spark, CURRENT_TRIPS), 10**9, p)
    open1 = spark.createDataFrame(r1.current_trips.collect(), CURRENT_TRIPS)
    r2 = run_batch(both, open1, 10**9, p).current_trips.first()
    speeds = _accepted(_positions(spark, {"A": fixes}), p, "A")
    # both cuts at accepted segments, so the runs' segments are those of one pass
    assert r2.total_readings == len(speeds)
    avg, _ = _fold(speeds)
    assert r2.average_speed_kph == avg


def test_seed_mean_above_a_lowered_limit(spark):
    """A mean above the anomaly limit widens grid and horizon: 250.00 sinks as the plain fold says."""
    fixes = [(i * 1000, 30.0 + 0.0000002 * i) for i in range(1, 900)]
    trip = [("A", 0, 500, 30.0, -97.0, 30.0, -97.0, 5.0, 250.0, 260.0, 30)]
    p = Params(anomaly_speed_kph=2.0, chunk_ms=100_000, fold_block=64)
    run = run_batch(_positions(spark, {"A": fixes}), spark.createDataFrame(trip, CURRENT_TRIPS), 10**7, p)
    got = run.current_trips.first()
    speeds = [r.seg_kph for r in run.rows.where("accepted = 1").orderBy("ts").collect()]
    assert got.total_readings == 30 + len(speeds) == 929
    assert got.average_speed_kph == _fold(speeds, 30, 250.0)[0]
