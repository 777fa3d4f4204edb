"""Naive per-vehicle simulation of one analytics run (test oracle for run_batch).

A direct, row-at-a-time reading of the original semantics: no chunks, no
windows, no horizon. Used only by tests on small random inputs.
"""

from __future__ import annotations

import math


def r2(x: float) -> float:
    y = x * 100.0
    f = math.floor(y)
    return (f + (1 if y - f >= 0.5 else 0)) / 100.0


def haversine(a1, o1, a2, o2, radius=6371000.0):
    k = 0.017453292519943295
    hd, hl = ((a2 - a1) * k) / 2, ((o2 - o1) * k) / 2
    a = math.sin(hd) * math.sin(hd) + (math.cos(a1 * k) * math.cos(a2 * k)) * math.sin(hl) * math.sin(hl)
    return radius * 2 * math.atan2(math.sqrt(a), math.sqrt(1 - a))


def run_once(positions: list[dict], trips: dict, as_of: int, p) -> dict:
    """Mutates ``positions`` (processed flags) and ``trips``; returns completed trips and alerts."""
    done, alerts = [], []

    def timeout(vin):
        t = trips.get(vin)
        if t is not None and as_of - t["last_update_timestamp"] > p.trip_timeout_ms:
            d = dict(t)
            d["trip_end_timestamp"] = d.pop("last_update_timestamp")
            d["end_lat"], d["end_lon"] = d.pop("last_lat"), d.pop("last_lon")
            d["duration_minutes"] = int((d["trip_end_timestamp"] - d["trip_start_timestamp"]) / 60000)
            done.append(d)
            del trips[vin]

    for vin in sorted({r["vin"] for r in positions}):
        todo = sorted((r for r in positions if r["vin"] == vin and not r["processed"]),
                      key=lambda r: (r["timestamp"], r["arrival_seq"]))
        if not todo:
            timeout(vin)
            continue
        trip = trips.get(vin)
        if trip is not None:
            todo = [r for r in todo if r["timestamp"] > trip["last_update_timestamp"]]
            todo.insert(0, dict(vin=vin, timestamp=trip["last_update_timestamp"], latitude=trip["last_lat"],
                                longitude=trip["last_lon"], processed=True, bridge=True))
        if len(todo) <= 1:
            timeout(vin)
            continue
        if trip is None:
            f = todo[0]
            trip = dict(vin=vin, trip_start_timestamp=f["timestamp"], last_update_timestamp=f["timestamp"],
                        start_lat=f["latitude"], start_lon=f["longitude"], last_lat=f["latitude"],
                        last_lon=f["longitude"], total_distance_meters=0.0, average_speed_kph=0.0,
                        max_speed_kph=0.0, total_readings=0)
        for a, b in zip(todo, todo[1:]):
            m = haversine(a["latitude"], a["longitude"], b["latitude"], b["longitude"], p.earth_radius_m)
            dt = (b["timestamp"] - a["timestamp"]) / 1000.0
            v = 0.0 if dt <= 0 else (m / dt) * 3.6
            if math.isnan(v) or v > p.anomaly_speed_kph:
                continue
            if m > p.jump_distance_m and dt < p.jump_window_s:
                continue
            trip["total_distance_meters"] += m
            trip["total_readings"] += 1
            n = trip["total_readings"]
            trip["last_update_timestamp"], trip["last_lat"], trip["last_lon"] = b["timestamp"], b["latitude"], b["longitude"]
            if v > trip["max_speed_kph"]:
                trip["max_speed_kph"] = r2(v)
            trip["average_speed_kph"] = r2((trip["average_speed_kph"] * (n - 1) + v) / n)
            if v > p.speed_limit_kph:
                alerts.append((vin, b["timestamp"], r2(v)))
            a["processed"] = True
        todo[-1]["processed"] = True
        trips[vin] = trip
    return dict(done=done, alerts=alerts)
