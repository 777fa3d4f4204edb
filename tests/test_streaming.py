"""Stream form of the trip fold: one micro-batch per run, compared with the batch run."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from geotrail.config import Params
from geotrail.schema import CAR_POSITIONS
from geotrail.streaming.stateful import open_trips, trip_stream, write_trip_stream
from tests.helpers import Fleet, k


def _write_batch(spark, folder, fixes, vin="VIN000001", seq0=0):
    rows = [(vin, t, lat, lon, 0.0, 0.0, 0.0, "", False, seq0 + i) for i, (t, lat, lon) in enumerate(fixes)]
    spark.createDataFrame(rows, CAR_POSITIONS).coalesce(1).write.mode("append").parquet(folder)


def _run_stream(spark, src, root, ckpt, p, event_time=False, api="transformWithState"):
    df = spark.readStream.schema(CAR_POSITIONS).option("maxFilesPerTrigger", 1).parquet(src)
    q = write_trip_stream(trip_stream(df, p, event_time=event_time, watermark="0 seconds", api=api), root, ckpt)
    finished = q.awaitTermination(180)
    if not finished:
        q.stop()
    assert finished, "bounded stream did not finish"
    return spark.read.parquet(root)


@pytest.mark.parametrize("api", ["transformWithState", "applyInPandasWithState"])
def test_stream_matches_batch_runs(spark, api):
    base = tempfile.mkdtemp(prefix="geotrail-stream-", dir="/tmp")
    src, root, ckpt = (os.path.join(base, x) for x in ("src", "out", "ckpt"))
    runs = [
        [k(0, 1000), k(1, 2000)],
        [k(2, 3000), k(5, 4000), k(6, 5000)],
        [k(7, 6000)],
    ]
    for i, fx in enumerate(runs):
        _write_batch(spark, src, fx, seq0=100 * i)
    p = Params()
    out = _run_stream(spark, src, root, ckpt, p, api=api)
    cur = open_trips(out).collect()
    f = Fleet(spark, params=p)
    for i, fx in enumerate(runs):
        f.send(*fx)
        f.run(10_000 + i)
    assert len(cur) == 1
    got = cur[0].asDict()
    want = f.trip()
    for c in want:
        if c != "vin":
            assert got[c] == pytest.approx(want[c], abs=1e-9), c
    alerts = sorted((r.timestamp, r.computed_speed_kph) for r in out.filter(F.col("kind") == "alert").collect())
    assert alerts == sorted((a["timestamp"], a["computed_speed_kph"]) for a in f.alerts)


@pytest.mark.parametrize("api", ["transformWithState", "applyInPandasWithState"])
def test_stream_event_time_timeout_and_pending(spark, api):
    base = tempfile.mkdtemp(prefix="geotrail-stream-", dir="/tmp")
    src, root, ckpt = (os.path.join(base, x) for x in ("src", "out", "ckpt"))
    _write_batch(spark, src, [k(0, 1000), k(1, 2000)])                 # trip for VIN 1
    _write_batch(spark, src, [k(0, 1500)], vin="VIN000002", seq0=50)  # lone fix waits
    _write_batch(spark, src, [k(0, 10_000_000)], vin="VIN000003", seq0=90)  # moves the watermark far ahead
    _write_batch(spark, src, [k(0, 10_000_001)], vin="VIN000004", seq0=95)  # one more batch: timers fire
    out = _run_stream(spark, src, root, ckpt, Params(), event_time=True, api=api)
    done = out.filter(F.col("kind") == "completed").collect()
    assert [(r.vin, r.trip_start_timestamp, r.last_update_timestamp, r.total_readings) for r in done] == [
        ("VIN000001", 1000, 2000, 1)
    ]
    assert open_trips(out).count() == 0


@pytest.mark.parametrize("event_time", [False, True])
def test_vehicle_behind_the_fleet_keeps_its_fixes(spark, event_time):
    """Vehicle 2 sends fresh fixes 10 h behind vehicle 1; re-sent copies count once."""
    base = tempfile.mkdtemp(prefix="geotrail-stream-", dir="/tmp")
    src, root, ckpt = (os.path.join(base, x) for x in ("src", "out", "ckpt"))
    ahead = 36_000_000
    runs = [
        ([k(0, ahead + 1000), k(1, ahead + 2000)], [k(0, 1000), k(1, 2000)]),
        ([k(2, ahead + 3000)], [k(1, 2000), k(2, 3000), k(5, 4000)]),
    ]
    from geotrail.schema import POSITIONS_RAW
    from geotrail.streaming.stateful import trip_stream_from_raw

    f1, f2 = Fleet(spark, params=Params()), Fleet(spark, params=Params())
    for i, (one, two) in enumerate(runs):
        rows = [(v, t, (la, lo), 0.0, 0.0, 0.0, "", 10 * i + n) for v, x in (("VIN000001", one), ("VIN000002", two)) for n, (t, la, lo) in enumerate(x)]
        spark.createDataFrame(rows, POSITIONS_RAW).coalesce(1).write.mode("append").parquet(src)
        f1.send(*one)
        f2.send(*[x for x in two if x[0] not in {r["timestamp"] for r in f2.positions}])
        f1.run(ahead + 5000)
        f2.run(5000)
    raw = spark.readStream.schema(POSITIONS_RAW).option("maxFilesPerTrigger", 1).parquet(src)
    q = trip_stream_from_raw(raw, root, ckpt, Params(trip_timeout_ms=10**9), event_time=event_time)
    assert q.awaitTermination(180)
    out = spark.read.parquet(root)
    got = {r.vin: (r.total_readings, r.last_update_timestamp, round(r.total_distance_meters, 6)) for r in open_trips(out).collect()}
    want = {v: (f.trip()["total_readings"], f.trip()["last_update_timestamp"], round(f.trip()["total_distance_meters"], 6)) for v, f in (("VIN000001", f1), ("VIN000002", f2))}
    assert got == want
    assert sorted(r.timestamp for r in out.filter("kind = 'alert' and vin = 'VIN000002'").collect()) == sorted(a["timestamp"] for a in f2.alerts)


def _naive(trip, pts, p):
    import math

    def r2(x):
        y = x * 100.0
        f = math.floor(y)
        return (f + (1 if y - f >= 0.5 else 0)) / 100.0

    k = 0.017453292519943295
    alerts = []
    for (t1, _, a1, o1), (t2, _, a2, o2) in zip(pts, pts[1:]):
        hd, hl = ((a2 - a1) * k) / 2, ((o2 - o1) * k) / 2
        a = math.sin(hd) * math.sin(hd) + (math.cos(a1 * k) * math.cos(a2 * k)) * math.sin(hl) * math.sin(hl)
        m = p.earth_radius_m * 2 * math.atan2(math.sqrt(a), math.sqrt(1 - a))
        dt = (t2 - t1) / 1000.0
        v = 0.0 if dt <= 0 else m / dt * 3.6
        if v > p.anomaly_speed_kph or (m > p.jump_distance_m and dt < p.jump_window_s):
            continue
        trip["total_distance_meters"] += m
        trip["total_readings"] += 1
        n = trip["total_readings"]
        trip["last_update_timestamp"], trip["last_lat"], trip["last_lon"] = t2, a2, o2
        if v > trip["max_speed_kph"]:
            trip["max_speed_kph"] = r2(v)
        trip["average_speed_kph"] = r2((trip["average_speed_kph"] * (n - 1) + v) / n)
        if v > p.speed_limit_kph:
            alerts.append((t2, r2(v)))
    return alerts


@pytest.mark.parametrize("anomaly", [2.0, 300.0])
def test_vectorized_step_equals_naive_loop(anomaly):
    import random

    from geotrail.streaming.stateful import _fold

    p = Params(anomaly_speed_kph=anomaly, speed_limit_kph=1.0)
    rnd = random.Random(5)
    pts, t, lat = [], 0, 30.0
    for i in range(3000):
        pts.append((t, i, lat, -97.0))
        t += rnd.choice([0, 1000, 1000, 2000])
        lat += rnd.choice([0.0, 0.000002, 0.000004, 0.00001, 0.5])
    start = dict(trip_start_timestamp=0, last_update_timestamp=0, start_lat=30.0, start_lon=-97.0, last_lat=30.0,
                 last_lon=-97.0, total_distance_meters=0.0, average_speed_kph=0.0, max_speed_kph=0.0, total_readings=0)
    a, b = dict(start), dict(start)
    got_alerts = [(r["timestamp"], r["computed_speed_kph"]) for r in _fold("V", a, pts, p)]
    want_alerts = _naive(b, pts, p)
    assert got_alerts == want_alerts
    for c in a:
        assert a[c] == pytest.approx(b[c], rel=1e-12, abs=1e-9), c


def test_stream_from_raw_messages(spark):
    from geotrail.schema import POSITIONS_RAW
    from geotrail.streaming.stateful import trip_stream_from_raw

    base = tempfile.mkdtemp(prefix="geotrail-stream-", dir="/tmp")
    src, root, ckpt = (os.path.join(base, x) for x in ("src", "out", "ckpt"))
    rows = [("VIN000001", t, (lat, lon), 0.0, 0.0, 0.0, "", i) for i, (t, lat, lon) in enumerate([k(0, 1000), k(1, 2000), k(2, 3000)])]
    rows.append(("VIN000001", 2000, (31.0, -97.73), 0.0, 0.0, 0.0, "", 9))  # re-sent copy, ignored
    spark.createDataFrame(rows, POSITIONS_RAW).coalesce(1).write.parquet(src)
    raw = spark.readStream.schema(POSITIONS_RAW).parquet(src)
    q = trip_stream_from_raw(raw, root, ckpt, Params())
    assert q.awaitTermination(180)
    cur = open_trips(spark.read.parquet(root)).collect()
    assert len(cur) == 1 and cur[0].total_readings == 2 and cur[0].last_update_timestamp == 3000


def test_step_all_late_after_timeout_leaves_no_pending():
    import pandas as pd

    from geotrail.streaming.stateful import _state_tuple, _step

    trip = dict(trip_start_timestamp=0, last_update_timestamp=10_000, start_lat=30.0, start_lon=-97.0,
                last_lat=30.1, last_lon=-97.0, total_distance_meters=5.0, average_speed_kph=1.0,
                max_speed_kph=1.0, total_readings=1)
    late = pd.DataFrame([dict(timestamp=9000, arrival_seq=1, latitude=30.0, longitude=-97.0)])
    new, out = _step("V", _state_tuple(trip, None), late, 10_000 + 300_001, Params())
    assert new is None and [r["kind"] for r in out] == ["completed"]
    new, out = _step("V", _state_tuple(trip, None), late, 10_000 + 300_000, Params())
    assert new == _state_tuple(trip, None) and out == []
    lone = pd.DataFrame([dict(timestamp=50_000, arrival_seq=2, latitude=30.0, longitude=-97.0)])
    new, out = _step("V", None, lone, 60_000, Params())
    assert new == _state_tuple(None, (50_000, 2, 30.0, -97.0)) and out == []


def test_ingest_to_store_keeps_lowest_arrival(spark):
    from geotrail.schema import POSITIONS_RAW
    from geotrail.sources.store import TripStore
    from geotrail.streaming.stateful import ingest_to_store

    base = tempfile.mkdtemp(prefix="geotrail-stream-", dir="/tmp")
    src, ckpt = os.path.join(base, "src"), os.path.join(base, "ckpt")
    rows = [
        ("V", 2000, (31.0, -97.73), 0.0, 0.0, 0.0, "", 7),   # later arrival, first in the file
        ("V", 1000, (30.266, -97.73), 0.0, 0.0, 0.0, "", 1),
        ("V", 2000, (30.2661, -97.73), 0.0, 0.0, 0.0, "", 2),  # first arrival of key 2000
    ]
    spark.createDataFrame(rows, POSITIONS_RAW).coalesce(1).write.parquet(src)
    later = [("V", 1000, (35.0, -97.73), 0.0, 0.0, 0.0, "", 9)]  # re-sent in a later batch
    spark.createDataFrame(later, POSITIONS_RAW).coalesce(1).write.mode("append").parquet(src)
    store = TripStore(spark, os.path.join(base, "store"))
    raw = spark.readStream.schema(POSITIONS_RAW).option("maxFilesPerTrigger", 1).parquet(src)
    q = ingest_to_store(raw, store, ckpt)
    assert q.awaitTermination(180)
    got = sorted((r.timestamp, round(r.latitude, 6), r.arrival_seq) for r in store.positions().collect())
    assert got == [(1000, 30.266, 1), (2000, 30.2661, 2)]
