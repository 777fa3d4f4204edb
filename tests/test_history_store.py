"""The history kept up to date (S6): appends against a full rebuild, and what an append reads."""

import random
import tempfile

import pytest

from geotrail.config import Params
from geotrail.operators import trips
from geotrail.schema import POSITIONS_RAW
from geotrail.sources.history import TripHistory, merged_spans
from geotrail.sources.store import TripStore

P = Params(trip_timeout_ms=300_000, chunk_ms=200_000, fold_block=4)


def _append(spark, store, rows):
    store.append_positions(spark.createDataFrame([(v, t, (la, -97.73), 0.0, 0.0, 0.0, "", s) for v, t, la, s in rows], POSITIONS_RAW))


def _equal(got, want):
    key = lambda r: (r.vin, r.trip_no)
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [key(r) for r in got] == [key(r) for r in want]
    for a, b in zip(got, want):
        for c in b.asDict():
            assert a[c] == b[c] or a[c] == pytest.approx(b[c], rel=1e-12), (c, a, b)


@pytest.mark.parametrize("seed", range(2))
def test_appends_equal_full_rebuild(spark, seed):
    """Late fixes extend, join and fill trips of earlier appends; lone fixes wait for neighbours."""
    rnd = random.Random(seed)
    store = TripStore(spark, tempfile.mkdtemp(prefix="geotrail-history-", dir="/tmp"))
    history, now, seq = TripHistory(store, P), 0, 0
    for k in range(4):
        rows = []
        for _ in range(40):
            now += rnd.choice([1000, 5000, 150_000, 300_000, 300_001, 3_000_000])
            seq += 1
            t = now if rnd.random() < 0.6 else rnd.randint(0, now)
            rows.append((f"V{rnd.randint(0, 2)}", t, 30 + rnd.randint(0, 60) * 1e-4, seq))
        _append(spark, store, rows)
        if k != 1:  # two appends at once
            assert history.extend() == k + 1
    assert history.extend() == 4  # nothing new: nothing changes
    _equal(history.read(now).collect(), trips.trip_segmentation(store._fixes(), P, now).collect())


def test_an_append_touches_only_near_trips(spark):
    """One late fix among a hundred trips: two trips are computed anew, and only their fixes are read."""
    store = TripStore(spark, tempfile.mkdtemp(prefix="geotrail-history-", dir="/tmp"))
    day = 86_400_000
    rows = [("A", d * day + 10_000 * i, 30 + i * 1e-4, 100 * d + i) for d in range(100) for i in range(4)]
    rows += [("A", 50 * day + 400_000 + 10_000 * i, 30.0, 90_000 + i) for i in range(3)]
    _append(spark, store, rows)
    history = TripHistory(store, P)
    history.extend()
    assert history._rows(1).count() == 101
    _append(spark, store, [("A", 50 * day + 200_000, 30.0, 99_999)])  # within the timeout of both
    seen = []
    read = TripHistory._fixes_in
    TripHistory._fixes_in = lambda self, ranges, upto: (seen.append(read(self, ranges, upto).count()), read(self, ranges, upto))[1]
    try:
        history.extend()
    finally:
        TripHistory._fixes_in = read
    assert seen == [7]
    assert spark.read.parquet(f"{store.root}/history").where("append = 2").count() == 1
    assert spark.read.parquet(f"{store.root}/replaced").where("append = 2").count() == 2
    _equal(history.read(10**12).collect(), trips.trip_segmentation(store._fixes(), P, 10**12).collect())


def test_a_killed_extension_is_taken_again(spark, monkeypatch):
    store = TripStore(spark, tempfile.mkdtemp(prefix="geotrail-history-", dir="/tmp"))
    history = TripHistory(store, P)
    _append(spark, store, [("A", 1000 * i, 30.0, i) for i in range(5)])
    history.extend()
    _append(spark, store, [("A", 1000 * i, 30.0, i) for i in range(5, 9)])
    with monkeypatch.context() as m:
        m.setattr(TripStore, "_commit", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            history.extend()
    assert [r.total_readings for r in history.read(10**9).collect()] == [4]
    history.extend()
    assert [r.total_readings for r in history.read(10**9).collect()] == [8]


def test_merged_spans(spark):
    schema = "vin string, first_ts long, last_ts long"
    old = spark.createDataFrame([("A", 0, 10), ("A", 30, 40), ("A", 60, 60), ("A", 200, 900), ("B", 0, 10)], schema)
    new = spark.createDataFrame([("A", 20, 20), ("A", 50, 55), ("A", 300, 310), ("C", 5, 5)], schema)
    touched, ranges = merged_spans(old, new, 10)
    assert sorted(map(tuple, touched.collect())) == [("A", 0, 10), ("A", 30, 40), ("A", 60, 60), ("A", 200, 900)]
    assert sorted(map(tuple, ranges.collect())) == [("A", 0, 60), ("A", 200, 900), ("C", 5, 5)]
    # one more than the gap apart: not reached
    assert merged_spans(old, spark.createDataFrame([("A", 21, 22)], schema), 7)[0].count() == 0


def test_spans_need_no_measured_segment(spark):
    """What an append reaches follows from times alone, joined across chunk borders."""
    store = TripStore(spark, tempfile.mkdtemp(prefix="geotrail-history-", dir="/tmp"))
    rows = [("A", t, 30.0, k) for k, t in enumerate([0, 150_000, 250_000, 450_000, 1_000_000])] + [("B", 7, 30.0, 9)]
    _append(spark, store, rows)
    spans = TripHistory(store, P)._spans(store._fixes())
    plan = spans._jdf.queryExecution().executedPlan().toString()
    read = plan[plan.index("ReadSchema:"):]
    assert "timestamp" in read and "latitude" not in read and plan.count("Exchange hashpartitioning") == 1
    none = spark.createDataFrame([], "vin string, first_ts long, last_ts long")
    got = merged_spans(none, spans, P.trip_timeout_ms)[1].collect()
    assert sorted(tuple(r) for r in got) == [("A", 0, 450_000), ("A", 1_000_000, 1_000_000), ("B", 7, 7)]
