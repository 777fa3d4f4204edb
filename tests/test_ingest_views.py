"""Ingest (I1-I3), rejection thresholds, read views."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from geotrail.config import Params
from geotrail.operators import chunked, trips
from geotrail.operators.segments import alerts_from_segments, fix_rows, run_segments, segment_table
from geotrail.plans import views
from geotrail.schema import CAR_POSITIONS, COMPLETED_TRIPS, CURRENT_TRIPS, POSITIONS_RAW, SPEED_ALERTS, empty
from geotrail.sources import ingest
from tests.helpers import Fleet


def raw(spark, rows):
    return spark.createDataFrame(rows, POSITIONS_RAW)


def test_normalize_applies_wire_defaults(spark):
    df = raw(spark, [("V1", 5, (1.0, 2.0), None, None, 3.0, None, 1), (None, None, None, 1.0, 2.0, None, "P0420", 2)])
    got = sorted(ingest.normalize(df).collect(), key=lambda r: r.arrival_seq)
    assert tuple(got[0]) == ("V1", 5, 1.0, 2.0, 0.0, 0.0, 3.0, "", False, 1)
    assert tuple(got[1]) == ("", 0, 0.0, 0.0, 1.0, 2.0, 0.0, "P0420", False, 2)


def test_duplicate_first_arrival_wins_g10(spark):
    df = raw(spark, [("V", 1000, (30.266, -97.73), 0.0, 0.0, 0.0, "", 1),
                     ("V", 1000, (30.3, -97.73), 0.0, 0.0, 0.0, "", 2),
                     ("V", 2000, (30.2661, -97.73), 0.0, 0.0, 0.0, "", 3)])
    pos = ingest.dedupe(ingest.normalize(df))
    assert sorted((r.timestamp, r.latitude) for r in pos.collect()) == [(1000, 30.266), (2000, 30.2661)]
    out = sorted(ingest.ingest_outcomes(df).collect(), key=lambda r: r.arrival_seq)
    assert [(r.success, r.message) for r in out] == [
        (True, "Saved successfully"), (False, "Duplicate position ignored"), (True, "Saved successfully")]
    f = Fleet(spark)
    for r in pos.collect():
        f.send((r.timestamp, r.latitude, r.longitude), vin="V")
    f.run(3000)
    t = f.trip("V")
    assert t["total_readings"] == 1 and t["total_distance_meters"] == pytest.approx(11.119, abs=1e-3)


def test_duplicate_against_stored_rows(spark):
    stored = ingest.normalize(raw(spark, [("VIN000000", 1000, (1.0, 1.0), 0.0, 0.0, 0.0, "", 1)]))
    again = raw(spark, [("VIN000000", 1000, (2.0, 2.0), 0.0, 0.0, 0.0, "", 5)])
    assert ingest.dedupe(ingest.normalize(again), stored).count() == 0
    o = ingest.ingest_outcomes(again, stored).collect()[0]
    assert (o.success, o.message) == (False, "Duplicate position ignored")


def test_jump_rule_g13(spark):
    pos = spark.createDataFrame(
        [("V", 5000, 30.266, -97.73, 0.0, 0.0, 0.0, "", False, 1), ("V", 5000, 30.276, -97.73, 0.0, 0.0, 0.0, "", False, 2)],
        CAR_POSITIONS)
    s = segment_table(run_segments(fix_rows(pos), Params())).collect()[0]
    assert s.distance_m == pytest.approx(1111.949, abs=1e-3) and s.speed_kph == 0.0
    assert (s.is_anomaly, s.is_jump, s.accepted) == (False, True, False)


@pytest.mark.parametrize("kph, alert", [(120.0, None), (120.001, 120.0), (300.0, 300.0)])
def test_alert_threshold_g14(spark, kph, alert):
    segs = spark.createDataFrame(
        [("V", 1, 1.0, 2.0, 1, kph, False)],
        "vin string, ts long, lat double, lon double, accepted int, seg_kph double, is_bridge boolean",
    )
    got = [r.computed_speed_kph for r in alerts_from_segments(segs, Params()).collect()]
    assert got == ([] if alert is None else [alert])


@pytest.mark.parametrize("step_deg, accepted", [(0.0026970, True), (0.0026990, False)])
def test_anomaly_threshold(spark, step_deg, accepted):
    # in 3.6 s, metres equal kph: 0.002697 deg of latitude ~ 299.89 kph, 0.002699 deg ~ 300.12 kph
    pos = spark.createDataFrame(
        [("V", 0, 30.0, -97.0, 0.0, 0.0, 0.0, "", False, 1), ("V", 3600, 30.0 + step_deg, -97.0, 0.0, 0.0, 0.0, "", False, 2)],
        CAR_POSITIONS)
    s = segment_table(run_segments(fix_rows(pos), Params())).collect()[0]
    assert (s.speed_kph <= 300.0) == accepted and s.accepted == accepted and s.is_anomaly == (not accepted)


def test_empty_stats_g15(spark):
    pos = spark.createDataFrame([("V", 1, 1.0, 1.0, 0.0, 0.0, 0.0, "", True, 1)], CAR_POSITIONS)
    v = views.vehicle_summary(pos, empty(spark, CURRENT_TRIPS), empty(spark, COMPLETED_TRIPS),
                              empty(spark, SPEED_ALERTS), 42).collect()[0]
    assert (v.vin, v.current_trip, v.completed_trips_count, v.total_distance_meters, v.average_speed_kph,
            v.speed_alerts_count, v.last_computed_at) == ("V", None, 0, 0.0, None, 0, 42)


def test_recent_positions_limit_and_plan(spark):
    pos = spark.createDataFrame([("V", t, 1.0, 1.0, 0.0, 0.0, 0.0, "", False, t) for t in range(20)], CAR_POSITIONS)
    got = views.recent_positions(pos, 3).collect()
    assert [r.timestamp for r in sorted(got, key=lambda r: r.rank)] == [19, 18, 17]
    with pytest.raises(ValueError):
        views.recent_positions(pos, 0)
    plan = views.recent_positions(pos, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_fleet_summary_counts(spark):
    pos = spark.createDataFrame([("A", 1, 1.0, 1.0, 0.0, 0.0, 0.0, "", True, 1), ("B", 1, 1.0, 1.0, 0.0, 0.0, 0.0, "", True, 2),
                                 ("A", 2, 1.0, 1.0, 0.0, 0.0, 0.0, "", True, 3)], CAR_POSITIONS)
    s = views.fleet_summary(pos, empty(spark, CURRENT_TRIPS), empty(spark, COMPLETED_TRIPS),
                            empty(spark, SPEED_ALERTS), 7).collect()[0]
    assert tuple(s) == (2, 0, 0, 0, 7)


def test_unknown_and_known_vins(spark):
    pos = spark.createDataFrame([("A", 1, 1.0, 1.0, 0.0, 0.0, 0.0, "", True, 1)], CAR_POSITIONS)
    req = spark.createDataFrame([("A",), ("Z",)], "vin string")
    assert [r.vin for r in views.unknown_vins(req, pos).collect()] == ["Z"]
    assert [r.vin for r in views.known_vins(req, pos).collect()] == ["A"]


def test_trip_stats_exact_mean(spark):
    done = spark.createDataFrame(
        [("V", 0, 1, 0.0, 0.0, 0.0, 0.0, 10.0, x, 0.0, 1, 0) for x in (0.1, 0.2, 0.3, 83.67, 83.68)], COMPLETED_TRIPS)
    r = views.trip_stats_by_vin(done).collect()[0]
    assert r.completed_trips_count == 5 and r.average_speed_kph == 16795 / 500 and r.total_distance_meters == 50.0


def test_completed_trips_and_alerts_newest_first(spark):
    done = spark.createDataFrame(
        [(v, t, t + 1, 0.0, 0.0, 0.0, 0.0, 1.0, 1.0, 1.0, 1, 0) for t in (5, 90, 30, 7) for v in ("B", "A")], COMPLETED_TRIPS)
    assert [(r.vin, r.trip_start_timestamp) for r in views.completed_trips(done.repartition(4)).collect()] == [
        (v, t) for v in ("A", "B") for t in (90, 30, 7, 5)]
    alerts = spark.createDataFrame([(v, t, 0.0, 0.0, 130.0, 120.0) for t in (5, 90, 30, 7) for v in ("B", "A")], SPEED_ALERTS)
    assert [r.timestamp for r in views.alerts_recent(alerts.repartition(4), ["B"]).collect()] == [90, 30, 7, 5]


@pytest.mark.parametrize("chunk_ms", [1, 50, 10**9])
def test_neighbours_equal_plain_windows(spark, chunk_ms):
    """Pairs and halo rows find the neighbours a window over the whole vehicle finds: ties, rows without
    a vehicle, single fixes, any chunk width."""
    rows = [(v, t, 30.0 + 0.001 * (t % 7), -97.0, 0.0, 0.0, 0.0, "", False, s)
            for v, n in (("A", 60), ("B", 1), ("C", 2), (None, 3)) for s, t in enumerate((x * 37) % 200 for x in range(n))]
    pos = fix_rows(spark.createDataFrame(rows + [("A", 37, 31.0, -97.0, 0.0, 0.0, 0.0, "", False, 99)], CAR_POSITIONS))
    p = Params(chunk_ms=chunk_ms)
    w = Window.partitionBy("vin").orderBy("ts", "seq")
    plain = pos.where("vin IS NOT NULL").withColumns({"prev": F.lag(chunked.point()).over(w), "next": F.lead(chunked.point()).over(w)})
    found = chunked.with_halo(chunked.add_chunk(pos, p))
    cols = ["vin", "ts", "seq", "prev", "next"]
    by = lambda df: sorted(map(str, df.select(*cols).collect()))
    assert by(found) == by(plain) and found.count() == 64
    assert found.where("is_late").count() == 0 and {r.vin for r in found.where("gated_in").collect()} == {"A", "C"}
    got = sorted((r.vin, r.from_ts, r.to_ts) for r in segment_table(run_segments(pos, p)).collect())
    assert got == sorted((r.vin, r.prev.ts, r.ts) for r in plain.collect() if r.prev) and len(got) == 61


def test_dense_vehicles_get_narrow_chunks(spark):
    """The chunk of a vehicle with a third of all fixes shrinks; the others keep theirs; results stay."""
    rows = [("HOT", 1000 * i, 30.0 + 0.0001 * (i % 9), -97.0, 0.0, 0.0, 0.0, "", False, i) for i in range(3000)]
    rows += [(f"V{i % 100}", 60_000 * i, 30.0 + 0.0001 * (i % 9), -97.0, 0.0, 0.0, 0.0, "", False, i) for i in range(6000)]
    pos = spark.createDataFrame(rows, CAR_POSITIONS)
    base = Params(chunk_ms=10**10)
    p = chunked.for_dense(pos, base, rows=100)
    assert [v for v, _ in p.dense] == ["HOT"] and 90_000 <= p.dense[0][1] <= 110_000
    chunks = chunked.add_chunk(fix_rows(pos), p).groupBy("vin", "chunk").count().collect()
    assert max(r["count"] for r in chunks) <= 110 and len([r for r in chunks if r.vin == "V7"]) == 1
    got, want = (sorted(trips.trip_rollup(pos, x).collect()) for x in (p, base))
    for a, b in zip(got, want):
        assert a[:-4] == b[:-4] and a[-3:] == b[-3:] and abs(a[-4] - b[-4]) < 1e-6
    assert chunked.for_dense(pos.limit(0), base).dense == ()
