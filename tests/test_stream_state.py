"""State of the stream: lasting duplicate rejection, micro-batches larger than memory, and the retry mode."""

import copy
import math
import os
import random
import shelve
import tempfile
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from geotrail.config import DUPLICATE_MESSAGE, SAVED_MESSAGE, TOO_OLD_MESSAGE, Params
from geotrail.schema import CAR_POSITIONS, POSITIONS_RAW
from geotrail.streaming.spill import POINT, Segments, SegmentWriter, Sorter, merged, ordered
from geotrail.streaming.stateful import TripProcessor, open_trips, trip_stream, trip_stream_from_raw, write_trip_stream
from geotrail.streaming.vehicle import DUPLICATE, SAVED, TOO_OLD, Seen
from tests.helpers import Fleet, k
from tests.sim import run_once
from tests.test_differential import _eq, _scenario


class FakeMap:
    """A map state over any dictionary."""

    def __init__(self, data=None):
        self.data = {} if data is None else data

    def containsKey(self, key):
        return repr(key) in self.data

    def getValue(self, key):
        return self.data[repr(key)]

    def updateValue(self, key, value):
        self.data[repr(key)] = value

    def removeKey(self, key):
        self.data.pop(repr(key), None)

    def keys(self):
        return [eval(x) for x in self.data]  # noqa: S307 - our own reprs


class FakeValue:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class FakeHandle:
    """One vehicle's state and timers."""

    def __init__(self, maps=dict):
        self.timers, self.maps, self.made = set(), maps, {}

    def getValueState(self, name, schema):
        return self.made.setdefault(name, FakeValue())

    def getMapState(self, name, key, value):
        return self.made.setdefault(name, FakeMap(self.maps()))

    def listTimers(self):
        return iter(self.timers)

    def deleteTimer(self, t):
        self.timers.discard(t)

    def registerTimer(self, t):
        self.timers.add(t)


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now

    def getCurrentWatermarkInMs(self):
        return self.now


def _frame(fixes):
    return pd.DataFrame(fixes, columns=["timestamp", "arrival_seq", "latitude", "longitude"])


def _processor(handle, p=Params(), **options):
    proc = TripProcessor(p, False, 0, options.pop("dedupe", False), **options)
    proc.init(handle)
    return proc


def _rows(frames):
    return [r for f in frames for r in f.to_dict("records")]


# ---- sorting beyond memory


def _points(n, seed, span):
    rng = np.random.default_rng(seed)
    pts = np.zeros(n, POINT)
    pts["t"], pts["s"], pts["la"] = rng.integers(0, span, n), rng.permutation(n), rng.random(n)
    return pts


@pytest.mark.parametrize("n,buffer_rows,segment_rows", [(0, 4, 2), (1, 4, 2), (10, 100, 7), (1000, 64, 10), (999, 1, 1), (5000, 777, 100)])
def test_sorter_equals_sort(n, buffer_rows, segment_rows):
    pts = _points(n, n, max(n // 3, 1))
    state = FakeMap()
    sorter = Sorter(Segments(state), buffer_rows, segment_rows)
    for part in np.array_split(pts, 7):
        sorter.add(part)
    assert n <= buffer_rows or state.data
    got = list(sorter.sorted())
    assert (np.concatenate(got) if got else pts).tolist() == ordered(pts).tolist()
    assert not state.data


def test_merged_streams_and_segments():
    parts = [ordered(_points(n, n, 50)) for n in (0, 3, 40, 41)]
    got = np.concatenate(list(merged([iter(np.array_split(x, 5)) for x in parts])))
    assert got[["t", "s"]].tolist() == ordered(np.concatenate(parts))[["t", "s"]].tolist()
    segments = Segments(FakeMap())
    writer = SegmentWriter(segments, 1, 8)
    for x in parts:
        writer.add(x)
    count = writer.close()
    assert count == math.ceil(84 / 8) and writer.total == 84
    assert np.concatenate(list(segments.read(1, count))).tolist() == np.concatenate(parts).tolist()


def test_ten_million_fixes_of_one_vehicle_in_bounded_memory(tmp_path):
    """One micro-batch of ten million fixes in no order: the trip is that of the sorted track, in some 100 MB."""
    n, step = 10_000_000, 1000
    # slow drift north and back: some 4 km/h, no alerts
    lat = lambda i: 30.0 + 1e-5 * np.minimum(i % 20_000, 20_000 - i % 20_000)

    def batches():
        # arrival order: a fixed permutation, in Arrow-sized frames
        for at in range(0, n, 100_000):
            i = (np.arange(at, at + 100_000, dtype=np.int64) * 7_368_787) % n
            yield pd.DataFrame({"timestamp": i * step, "arrival_seq": np.arange(at, at + 100_000), "latitude": lat(i), "longitude": -97.0})

    disk = shelve.open(str(tmp_path / "state"), protocol=5)
    proc = _processor(FakeHandle(lambda: disk))
    tracemalloc.start()
    out = _rows(proc.handleInputRows(("HOT",), batches(), Clock(n * step)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    disk.close()
    trip = out[-1]
    assert trip["kind"] == "trip" and trip["total_readings"] == n - 1 and trip["last_update_timestamp"] == (n - 1) * step
    assert trip["total_distance_meters"] == pytest.approx((n - 1) * 6371000.0 * math.radians(1e-5), rel=1e-4)
    assert peak < 150e6, peak


def test_spilled_batch_equals_held_batch():
    rnd = random.Random(2)
    fixes = [(1000 * i, i, 30.0 + rnd.uniform(0, 0.0005), -97.0) for i in range(3000)]
    rnd.shuffle(fixes)
    outs = []
    for rows in (50, 10**6):
        handle = FakeHandle()
        proc = _processor(handle, buffer_rows=rows, segment_rows=16, dedupe=True)
        out = []
        for at in range(0, 3000, 1000):
            out += _rows(proc.handleInputRows(("V",), iter([_frame(fixes[at : at + 500]), _frame(fixes[at + 500 : at + 1000])]), Clock(0)))
        assert not handle.made["spill"].data
        outs.append(out)
    assert [r["kind"] for r in outs[0]] == [r["kind"] for r in outs[1]]
    for a, b in zip(*outs):
        for c in a:
            assert a[c] == b[c] or a[c] != a[c] or a[c] == pytest.approx(b[c], rel=1e-12)


# ---- lasting duplicate rejection


def test_seen_remembers_and_forgets():
    state = FakeMap()
    seen = Seen(state, chunk_ms=100, remember_ms=1000)
    pts = lambda *ts: np.array([(t, i, 0.0, 0.0) for i, t in enumerate(ts)], POINT)
    assert seen.outcomes(pts(5, 5, 150, 2000), None).tolist() == [SAVED, DUPLICATE, SAVED, SAVED]
    assert seen.forget(2000, None) == 10 and {x[0] for x in state.keys()} == {20}
    # older than the memory: refused unseen; inside it: looked up
    assert seen.outcomes(pts(5, 999, 1000, 2000, 2001), 2000).tolist() == [TOO_OLD, TOO_OLD, SAVED, DUPLICATE, SAVED]
    assert seen.outcomes(pts(1000), 2001).tolist() == [TOO_OLD]
    assert seen.outcomes(pts(2001, 2500), 2001).tolist() == [DUPLICATE, SAVED]


def test_negative_and_boundary_timestamps():
    seen = Seen(FakeMap(), chunk_ms=100)
    pts = np.array([(t, i, 0.0, 0.0) for i, t in enumerate((-101, -100, -1, 0, 99, 100))], POINT)
    assert (seen.outcomes(pts, None) == SAVED).all() and (seen.outcomes(pts, 100) == DUPLICATE).all()


def _raw(spark, folder, fixes, vin="VIN000001", seq0=0):
    rows = [(vin, t, (la, lo), 0.0, 0.0, 0.0, "", seq0 + i) for i, (t, la, lo) in enumerate(fixes)]
    spark.createDataFrame(rows, POSITIONS_RAW).coalesce(1).write.mode("append").parquet(folder)


def _folders():
    base = tempfile.mkdtemp(prefix="geotrail-stream-", dir="/tmp")
    return [os.path.join(base, x) for x in ("src", "out", "ckpt")]


def test_copies_after_the_trip_closed_start_nothing(spark):
    """Three fixes, the trip closed by the timer, the same three again: no trip; every message has its outcome."""
    src, root, ckpt = _folders()
    fixes = [k(0, 1000), k(1, 2000), k(2, 3000)]
    _raw(spark, src, fixes)
    _raw(spark, src, [k(0, 10_000_000)], vin="VIN000003", seq0=90)   # the fleet's clock moves on
    _raw(spark, src, [k(0, 10_000_001)], vin="VIN000004", seq0=95)   # the timer fires
    _raw(spark, src, [(t, la + 1, lo) for t, la, lo in fixes], seq0=200)
    _raw(spark, src, [k(9, 2500), k(9, 3500), k(10, 4000)], seq0=300)  # new timestamps are fixes like any other
    raw = spark.readStream.schema(POSITIONS_RAW).option("maxFilesPerTrigger", 1).parquet(src)
    q = trip_stream_from_raw(raw, root, ckpt, Params(), event_time=True, watermark="0 seconds", outcomes=True, buffer_rows=2, segment_rows=1)
    assert q.awaitTermination(240)
    out = spark.read.parquet(root)
    done = out.filter("kind = 'completed' and vin = 'VIN000001'").orderBy("trip_start_timestamp").collect()
    assert (done[0].trip_start_timestamp, done[0].last_update_timestamp, done[0].total_readings) == (1000, 3000, 2)
    trips = out.filter("kind = 'trip' and vin = 'VIN000001'").orderBy("batch_id").collect()
    assert [(t.trip_start_timestamp, t.total_readings) for t in trips] == [(1000, 2), (2500, 2)]
    got = {r.arrival_seq: (r.saved, r.message) for r in out.filter("kind = 'outcome' and vin = 'VIN000001'").collect()}
    assert got == {**{i: (True, SAVED_MESSAGE) for i in (0, 1, 2, 300, 301, 302)}, **{i: (False, DUPLICATE_MESSAGE) for i in (200, 201, 202)}}


def test_older_than_memory_is_refused(spark):
    handle = FakeHandle()
    proc = _processor(handle, Params(chunk_ms=1000), dedupe=True, outcomes=True, remember_ms=10_000)
    send = lambda *ts: _rows(proc.handleInputRows(("V",), iter([_frame([(t, i, 30.0, -97.0) for i, t in enumerate(ts)])]), Clock(0)))
    send(1000, 2000, 50_000)
    assert {x[0] for x in handle.made["seen"].keys()} == {50}
    got = [r["message"] for r in send(1000, 45_000, 50_000) if r["kind"] == "outcome"]
    assert got == [TOO_OLD_MESSAGE, SAVED_MESSAGE, DUPLICATE_MESSAGE]


# ---- retry mode: a stream that equals the batch run


def _stream_runs(runs, p, **options):
    """Drive one processor per vehicle: input rows, or its timer where it has none. Yields outputs per run."""
    procs, seq = {}, 0
    for batch, as_of in runs:
        out, new = [], {}
        for vin, t, lat, lon in batch:
            seq += 1
            new.setdefault(vin, []).append((t, seq, lat, lon))
        for vin in new:
            if vin not in procs:
                handle = FakeHandle()
                procs[vin] = (_processor(handle, p, **options), handle)
        for vin, (proc, handle) in procs.items():
            if vin in new:
                out += _rows(proc.handleInputRows((vin,), iter([_frame(new[vin])]), Clock(as_of)))
            elif any(t <= as_of for t in handle.timers):
                handle.timers = {t for t in handle.timers if t > as_of}
                out += _rows(proc.handleExpiredTimer((vin,), Clock(as_of), None))
        yield out


@pytest.mark.parametrize("seed", range(400))
def test_retry_stream_equals_simulated_runs(seed):
    """Random runs with late fixes, spikes, ties and timeouts: trips, completions, alerts, ghost trips included."""
    p = Params()
    sim_pos, sim_trips, seq, open_now = [], {}, 0, {}
    runs = _scenario(seed)
    runs.append(([], runs[-1][1] + 10**6))
    runs.append(([], runs[-1][1] + 10**6))
    for (batch, as_of), out in zip(runs, _stream_runs(runs, p, retry=True, buffer_rows=3, segment_rows=2)):
        for vin, t, lat, lon in batch:
            seq += 1
            sim_pos.append(dict(vin=vin, timestamp=t, latitude=lat, longitude=lon, processed=False, arrival_seq=seq))
        want = run_once(sim_pos, sim_trips, as_of, p)
        assert sorted((r["vin"], r["timestamp"], r["computed_speed_kph"]) for r in out if r["kind"] == "alert") == sorted(want["alerts"])
        done = sorted((r for r in out if r["kind"] == "completed"), key=lambda r: r["vin"])
        assert [(r["vin"], r["last_update_timestamp"], r["total_readings"]) for r in done] == [
            (w["vin"], w["trip_end_timestamp"], w["total_readings"]) for w in sorted(want["done"], key=lambda w: w["vin"])
        ]
        for r in out:
            if r["kind"] == "trip":
                open_now[r["vin"]] = r
            elif r["kind"] == "completed":
                del open_now[r["vin"]]
        assert sorted(open_now) == sorted(sim_trips)
        for vin, trip in sim_trips.items():
            for c, v in trip.items():
                assert _eq(open_now[vin][c], v), (vin, c)


def test_retry_scenarios_have_ghost_trips():
    """The scenarios above do differ from a stream that consumes each fix once."""
    kinds = lambda seed, **o: [sorted((r["kind"], r["vin"]) for r in out) for out in _stream_runs(_scenario(seed), Params(), **o)]
    assert sum(kinds(seed) != kinds(seed, retry=True) for seed in range(100)) > 10


def test_retry_stream_equals_run_batch(spark):
    """The same on Spark: four micro-batches through RocksDB against four batch runs."""
    src, root, ckpt = _folders()
    p = Params(trip_timeout_ms=10**15)
    f = Fleet(spark, params=p)
    batches = [
        [k(0, 1000), (2000, 31.0, -97.73), k(1, 3000)],      # a spike: its start and the spike stay behind
        [k(2, 1500), k(3, 4000)],                            # late, and new
        [(5000, 32.0, -97.73)],                              # rejected: the bridge's segment
        [k(5, 6000), k(6, 7000)],
    ]
    seq = 0
    for i, fixes in enumerate(batches):
        rows = [("VIN000001", t, la, lo, 0.0, 0.0, 0.0, "", False, seq + n + 1) for n, (t, la, lo) in enumerate(fixes)]
        seq += len(rows)
        spark.createDataFrame(rows, CAR_POSITIONS).coalesce(1).write.mode("append").parquet(src)
        f.send(*fixes)
        f.run(10_000 + i)
    df = spark.readStream.schema(CAR_POSITIONS).option("maxFilesPerTrigger", 1).parquet(src)
    q = write_trip_stream(trip_stream(df, p, retry=True), root, ckpt)
    assert q.awaitTermination(240)
    out = spark.read.parquet(root)
    got, want = open_trips(out).first().asDict(), f.trip()
    for c in want:
        assert _eq(got[c], want[c]), c
    assert sorted(r.timestamp for r in out.filter(F.col("kind") == "alert").collect()) == sorted(a["timestamp"] for a in f.alerts)


def test_leftovers_survive_in_segments():
    """Late fixes pile up over runs in segments, and count again once the trip has closed."""
    p = Params()
    handle = FakeHandle()
    proc = _processor(handle, p, retry=True, segment_rows=4)
    feed = lambda fixes, now: _rows(proc.handleInputRows(("V",), iter([_frame(fixes)]), Clock(now)))
    feed([(100_000, 1, 30.0, -97.0), (101_000, 2, 30.0, -97.0)], 101_000)
    for i in range(10):
        feed([(1000 * i, 10 + i, 30.0, -97.0)], 101_000)
    notes = handle.made["notes"].value
    assert notes[1] == 3 and len(handle.made["left"].data) == 3
    out = _rows(proc.handleExpiredTimer(("V",), Clock(10**6), None))
    assert [r["kind"] for r in out] == ["completed"]
    out = _rows(proc.handleExpiredTimer(("V",), Clock(10**6 + 1), None))
    assert [(r["kind"], r["trip_start_timestamp"], r["total_readings"]) for r in out] == [("trip", 0, 9)]
    assert not handle.made["left"].data
    assert copy.copy(handle.timers)


# ---- the open trips beside the outputs


def _outputs(spark, batch_id, rows):
    from geotrail.streaming.stateful import OUTPUT_SCHEMA, _row

    trip = dict(trip_start_timestamp=1, start_lat=0.0, start_lon=0.0, last_lat=0.0, last_lon=0.0, total_distance_meters=0.0,
                average_speed_kph=0.0, max_speed_kph=0.0)
    data = [_row(kind, vin, last_update_timestamp=t, total_readings=n, **trip) for kind, vin, t, n in rows]
    return spark.createDataFrame([tuple(r[f.name] for f in OUTPUT_SCHEMA) for r in data], OUTPUT_SCHEMA)


def test_open_trips_are_kept_by_bucket(spark):
    """Random updates and completions: the snapshot equals the latest version of all outputs; replays change nothing;
    a read opens one batch per bucket however many there were."""
    from geotrail.streaming.snapshot import OpenTrips

    rnd = random.Random(4)
    base = tempfile.mkdtemp(prefix="geotrail-stream-", dir="/tmp")
    table = OpenTrips(spark, f"{base}/out", n_buckets=4)
    assert table.read().count() == 0 and table.origin() is None
    want, sizes = {}, []
    for b in range(8):
        rows = []
        for vin in rnd.sample([f"V{i}" for i in range(12)], 0 if b == 3 else rnd.randint(1, 5)):
            kind = rnd.choice(["trip", "trip", "completed"])
            rows.append((kind, vin, 100 * b, b))
            want.pop(vin, None)
            if kind == "trip":
                want[vin] = (100 * b, b)
        for _ in range(2 if b in (2, 5) else 1):  # a replayed batch
            table.merge(_outputs(spark, b, rows), b, "ckpt")
        got = {r.vin: (r.last_update_timestamp, r.total_readings) for r in table.read().collect()}
        assert got == want, b
        sizes.append(table._versions().where("bucket >= 0").select("version").distinct().count())
    assert max(sizes) <= 4 and table.origin() == "ckpt"
    # a batch that died before its version table has not happened
    table.merge(_outputs(spark, 8, [("trip", "V0", 9999, 9)]), 8, "ckpt")
    import shutil

    shutil.rmtree(f"{base}/out_open/versions/batch_id=8")
    spark.catalog.clearCache()
    assert {r.vin: (r.last_update_timestamp, r.total_readings) for r in OpenTrips(spark, f"{base}/out", 4).read().collect()} == want


def test_snapshot_of_a_stream_and_foreign_checkpoint(spark):
    from geotrail.streaming.snapshot import OpenTrips

    src, root, ckpt = _folders()
    for i, fixes in enumerate(([k(0, 1000), k(1, 2000)], [k(2, 3000)], [k(0, 1000), k(1, 1500)])):
        _raw(spark, src, fixes, vin="VIN000002" if i == 2 else "VIN000001", seq0=10 * i)
    raw = spark.readStream.schema(POSITIONS_RAW).option("maxFilesPerTrigger", 1).parquet(src)
    assert trip_stream_from_raw(raw, root, ckpt, Params(trip_timeout_ms=10**15)).awaitTermination(240)
    assert sorted(map(tuple, OpenTrips(spark, root).read().collect())) == sorted(map(tuple, open_trips(spark.read.parquet(root)).collect()))
    with pytest.raises(ValueError):
        trip_stream_from_raw(raw, root, ckpt + "2", Params())


def test_runs_at_a_cadence(spark):
    """A processing-time trigger runs the stream again and again; fixes that come meanwhile enter the next run."""
    import time

    src, root, ckpt = _folders()
    _raw(spark, src, [k(0, 1000), k(1, 2000)])
    raw = spark.readStream.schema(POSITIONS_RAW).parquet(src)
    q = trip_stream_from_raw(raw, root, ckpt, Params(trip_timeout_ms=10**15), trigger={"processingTime": "1 seconds"})
    try:
        end = time.time() + 120
        while (q.lastProgress or {}).get("batchId", -1) < 0 and time.time() < end:
            time.sleep(0.2)
        _raw(spark, src, [k(2, 3000)], seq0=10)
        while spark.read.parquet(root).where("kind = 'trip' and total_readings = 2").count() == 0 and time.time() < end:
            time.sleep(0.5)
    finally:
        q.stop()
    out = spark.read.parquet(root)
    assert [r.total_readings for r in out.where("kind = 'trip'").orderBy("batch_id").collect()][-1] == 2
    assert out.select("batch_id").distinct().count() >= 2


def test_packed_rows_are_output_rows(spark):
    """Every kind of output row passes the packed form unchanged (a NaN as a null, as before)."""
    from geotrail.streaming.stateful import OUTPUT_SCHEMA, PACKED_SCHEMA, TRIP_NAMES, _row, packed_frame, unpacked

    trip = {n: 2 if n in ("trip_start_timestamp", "last_update_timestamp", "total_readings") else 0.5 for n in TRIP_NAMES}
    rows = [
        _row("trip", "A", **trip), _row("completed", "A", **trip, duration_minutes=3),
        _row("alert", "B", timestamp=1, latitude=float("nan"), longitude=2.0, computed_speed_kph=3.0, speed_limit_kph=4.0),
        _row("outcome", "B", timestamp=1, arrival_seq=(1 << 60) + 1, saved=False, message="m"),
    ]
    data = [(r.kind, r.vin, r.message, r.longs, r.doubles) for r in packed_frame(rows).itertuples()]
    got = unpacked(spark.createDataFrame(data, PACKED_SCHEMA))
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in OUTPUT_SCHEMA]
    rows[2]["latitude"] = None
    assert [r.asDict() for r in got.collect()] == rows


def test_one_frame_per_vehicle_has_few_columns():
    handle = FakeHandle()
    from geotrail.streaming.stateful import PackedTripProcessor

    proc = PackedTripProcessor(Params(), False, 0, False, retry=True)
    proc.init(handle)
    out = list(proc.handleInputRows(("A",), iter([_frame([(0, 0, 30.0, -97.0), (10_000, 1, 30.001, -97.0)])]), Clock(20_000)))
    assert len(out) == 1 and len(out[0].columns) == 5 and out[0].kind.tolist() == ["trip"]
