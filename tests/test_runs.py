"""Incremental runs: the reference's asserted cases and our scenarios G1-G10 (FIXTURES.md)."""

import pytest

from geotrail.config import Params
from tests.helpers import Fleet, k, spike, state_e

T = 1_000_000


def approx(x, a=1e-3):
    return pytest.approx(x, abs=a)


# ---- cases asserted by the reference's tests ------------------------------------------------


def test_new_trip(spark):
    f = Fleet(spark)
    f.send((1000, 30.266, -97.730), (11000, 30.265, -97.7285))
    out = f.run(20_000)
    t = f.trip()
    assert (t["trip_start_timestamp"], t["start_lat"], t["start_lon"]) == (1000, 30.266, -97.730)
    assert t["total_distance_meters"] == approx(181.981)
    assert t["average_speed_kph"] == t["max_speed_kph"] == 65.51
    assert t["total_readings"] == 1 and t["last_update_timestamp"] == 11000
    assert out["alerts"] == []


def test_trip_update_mean_exact(spark):
    f = Fleet(spark)
    f.set_trip(**state_e(T))
    f.send((T + 11000, 30.266, -97.730), (T + 21000, 30.265, -97.731))
    f.run(T + 30_000)
    t = f.trip()
    assert t["total_readings"] == 5
    assert (t["last_update_timestamp"], t["last_lat"], t["last_lon"]) == (T + 21000, 30.265, -97.731)
    assert t["total_distance_meters"] == approx(10413.932)
    assert t["average_speed_kph"] == 58.35
    assert t["max_speed_kph"] == 87.38
    assert (t["trip_start_timestamp"], t["start_lat"]) == (0, 30.266)


def test_trip_update_two(spark):
    f = Fleet(spark)
    f.set_trip(**state_e(T))
    f.send((T + 1000, 30.264, -97.728), (T + 2000, 30.2639, -97.7282))
    f.run(T + 3000)
    t = f.trip()
    assert t["total_readings"] == 5 and t["last_update_timestamp"] == T + 2000
    assert t["total_distance_meters"] == approx(10053.078)
    assert (t["average_speed_kph"], t["max_speed_kph"]) == (68.52, 111.18)


def test_one_alert(spark):
    f = Fleet(spark)
    f.set_trip(**state_e(T))
    f.send((T + 1000, 30.264, -97.728), (T + 2000, 30.2642, -97.7284))
    out = f.run(T + 3000)
    assert len(out["alerts"]) == 1
    a = out["alerts"][0]
    assert (a["timestamp"], a["computed_speed_kph"], a["speed_limit_kph"]) == (T + 2000, 159.8, 120.0)
    assert (a["latitude"], a["longitude"]) == (30.2642, -97.7284)
    assert f.trip()["average_speed_kph"] == 84.5


def test_two_alerts(spark):
    f = Fleet(spark)
    f.set_trip(**state_e(T))
    f.send((T + 1000, 30.2639, -97.728), (T + 2000, 30.2640, -97.7284))
    out = f.run(T + 3000)
    got = sorted((a["timestamp"], a["computed_speed_kph"]) for a in out["alerts"])
    assert got == [(T + 1000, 131.03), (T + 2000, 143.98)]
    assert f.trip()["average_speed_kph"] == 85.3


def test_timeout_completes_trip(spark):
    now = 5_000_000
    f = Fleet(spark)
    f.send((100, 30.0, -97.0))
    f.positions[0]["processed"] = True  # the vehicle has stored fixes, none new
    f.set_trip(**state_e(now - 700_000))
    out = f.run(now)
    assert len(out["done"]) == 1 and f.trip() is None
    d = out["done"][0]
    assert d["trip_end_timestamp"] == now - 700_000 and d["duration_minutes"] == (now - 700_000) // 60000
    assert (d["end_lat"], d["end_lon"], d["total_readings"]) == (30.2641, -97.7283, 3)


def test_all_late(spark):
    now = 5_000_000
    f = Fleet(spark)
    f.set_trip(**state_e(now + 5000))
    f.send((now + 1000, 30.264, -97.728), (now + 2000, 30.2639, -97.7282))
    out = f.run(now)
    assert f.trip() == state_e(now + 5000)
    assert f.unprocessed() == {now + 1000, now + 2000}
    assert out["done"] == [] and out["alerts"] == []


# ---- behaviour the reference does not test -----------------------------------------------------


def test_g1_spike(spark):
    f = Fleet(spark)
    f.send(k(0, 1000), k(1, 2000), spike(3000), k(3, 4000), k(4, 5000))
    f.run(6000)
    t = f.trip()
    assert (t["trip_start_timestamp"], t["last_update_timestamp"]) == (1000, 5000)
    assert t["total_distance_meters"] == approx(22.239)
    assert (t["average_speed_kph"], t["max_speed_kph"], t["total_readings"]) == (40.03, 40.03, 2)
    assert f.unprocessed() == {2000, 3000}


def test_g2_two_trailing_rejects(spark):
    f = Fleet(spark)
    f.send(k(0, 1000), k(1, 2000), spike(3000), spike(4000, 32.0))
    f.run(5000)
    t = f.trip()
    assert t["last_update_timestamp"] == 2000 and t["total_readings"] == 1
    assert t["total_distance_meters"] == approx(11.119)
    assert f.unprocessed() == {2000, 3000}
    f.send(k(4, 5000), k(5, 6000))
    f.run(7000)
    t = f.trip()
    assert t["last_update_timestamp"] == 6000 and t["total_readings"] == 2
    assert t["total_distance_meters"] == approx(22.239)
    assert f.unprocessed() == {2000, 3000}


def test_g3_lone_fix_waits(spark):
    f = Fleet(spark)
    f.send(k(0, 1000))
    f.run(2000)
    assert f.trip() is None and f.unprocessed() == {1000}
    f.send(k(1, 2000))
    f.run(3000)
    t = f.trip()
    assert (t["trip_start_timestamp"], t["last_update_timestamp"], t["total_readings"]) == (1000, 2000, 1)
    assert t["total_distance_meters"] == approx(11.119)
    assert f.unprocessed() == set()


def test_g4_all_rejected_still_saves_trip(spark):
    f = Fleet(spark)
    f.send((1000, 30.0, -97.73), (2000, 31.0, -97.73), (3000, 32.0, -97.73))
    f.run(4000)
    t = f.trip()
    assert (t["trip_start_timestamp"], t["last_update_timestamp"]) == (1000, 1000)
    assert (t["total_distance_meters"], t["total_readings"], t["average_speed_kph"], t["max_speed_kph"]) == (0.0, 0, 0.0, 0.0)
    assert f.unprocessed() == {1000, 2000}


@pytest.mark.parametrize("as_of, closes", [(2000 + 300_000, False), (2000 + 300_001, True)])
def test_g5_timeout_edge(spark, as_of, closes):
    f = Fleet(spark)
    f.send(k(0, 1000), k(1, 2000))
    f.run(3000)
    out = f.run(as_of)
    if not closes:
        assert f.trip() is not None and out["done"] == []
    else:
        assert f.trip() is None
        d = out["done"][0]
        assert (d["trip_start_timestamp"], d["trip_end_timestamp"], d["duration_minutes"]) == (1000, 2000, 0)
        assert (d["average_speed_kph"], d["max_speed_kph"], d["total_readings"]) == (40.03, 40.03, 1)
        assert d["total_distance_meters"] == approx(11.119)


def test_g6_duration(spark):
    f = Fleet(spark)
    f.send(k(0, 0), k(1, 125_999))
    f.run(126_000)
    out = f.run(600_000)
    d = out["done"][0]
    assert d["duration_minutes"] == 2 and d["average_speed_kph"] == d["max_speed_kph"] == 0.32
    assert d["total_readings"] == 1


def test_g7_ghost_trip(spark):
    f = Fleet(spark)
    f.send(k(0, 10_000), k(1, 11_000))
    f.run(12_000)
    f.send(k(0, 5000), k(1, 6000))
    f.run(13_000)
    t = f.trip()
    assert (t["trip_start_timestamp"], t["last_update_timestamp"]) == (10_000, 11_000)
    assert f.unprocessed() == {5000, 6000}
    out = f.run(400_000)
    assert [(d["trip_start_timestamp"], d["trip_end_timestamp"]) for d in out["done"]] == [(10_000, 11_000)]
    f.run(1_000_000)
    t = f.trip()
    assert (t["trip_start_timestamp"], t["last_update_timestamp"]) == (5000, 6000)
    assert t["total_distance_meters"] == approx(11.119)
    out = f.run(1_600_000)
    assert [(d["trip_start_timestamp"], d["trip_end_timestamp"]) for d in out["done"]] == [(5000, 6000)]
    assert f.trip() is None


def test_g8_gap_inside_one_run(spark):
    f = Fleet(spark)
    f.send(k(0, 0), k(1, 1000), k(2, 3_600_000), k(3, 3_601_000))
    f.run(3_602_000)
    t = f.trip()
    assert (t["trip_start_timestamp"], t["last_update_timestamp"], t["total_readings"]) == (0, 3_601_000, 3)
    assert t["total_distance_meters"] == approx(33.358)
    assert (t["average_speed_kph"], t["max_speed_kph"]) == (26.69, 40.03)


def test_g9_gap_across_runs_with_data(spark):
    f = Fleet(spark)
    f.send(k(0, 1000), k(1, 2000))
    f.run(3000)
    f.send(k(9, 900_000))
    out = f.run(901_000)
    t = f.trip()
    assert out["done"] == []
    assert (t["trip_start_timestamp"], t["last_update_timestamp"], t["total_readings"]) == (1000, 900_000, 2)
    assert t["total_distance_meters"] == approx(100.075)
    assert (t["average_speed_kph"], t["max_speed_kph"]) == (20.19, 40.03)


def test_many_vehicles_in_one_run_are_independent(spark):
    f = Fleet(spark)
    f.send(k(0, 1000), k(1, 2000), vin="A")
    f.send(k(0, 1000), spike(2000), k(2, 3000), vin="B")
    f.send(k(0, 1000), vin="C")
    f.run(10_000)
    assert f.trip("A")["total_readings"] == 1
    assert f.trip("B")["total_readings"] == 0 and f.unprocessed("B") == {1000, 2000}
    assert f.trip("C") is None and f.unprocessed("C") == {1000}


def _chunk_scenario(spark, chunk_ms):
    f = Fleet(spark, params=Params(chunk_ms=chunk_ms))
    f.send(k(0, 10_000), k(1, 11_000))
    f.run(12_000)
    f.send(k(0, 5000), k(2, 12_000), spike(13_000), k(4, 14_000), k(5, 15_000), k(9, 16_000))
    out = f.run(17_000)
    return f, out


@pytest.mark.parametrize("chunk_ms", [1, 1500, 10**12])
def test_chunk_width_does_not_change_runs(spark, chunk_ms):
    """Chunk boundaries between every fix (1 ms) or none at all give the same run."""
    f, out = _chunk_scenario(spark, chunk_ms)
    t = f.trip()
    # bridge->k2, k4->k5 and k5->k9 accepted; k2->S and S->k4 rejected; k0@5000 late
    assert f.unprocessed() == {5000, 12_000, 13_000}
    assert (t["trip_start_timestamp"], t["last_update_timestamp"], t["total_readings"]) == (10_000, 16_000, 4)
    assert t["total_distance_meters"] == approx(11.1195 * 7, 1e-2)
    assert [(a["timestamp"], a["computed_speed_kph"]) for a in out["alerts"]] == [(16_000, 160.12)]


@pytest.mark.parametrize("chunk_ms", [1, 1500, 10**12])
def test_late_rule_ties_and_earlier_chunks(spark, chunk_ms):
    """Fixes at or before the open trip's last update are late, also at equal time."""
    f = Fleet(spark, params=Params(chunk_ms=chunk_ms))
    f.set_trip(**{**state_e(10_000), "last_lat": 30.266, "last_lon": -97.73})
    f.send(k(0, 5000), k(3, 10_000), k(1, 10_500), k(2, 11_000))
    f.run(12_000)
    t = f.trip()
    assert f.unprocessed() == {5000, 10_000}
    assert (t["last_update_timestamp"], t["total_readings"]) == (11_000, 5)
    assert t["total_distance_meters"] == approx(10_000 + 2 * 11.1195, 1e-2)
