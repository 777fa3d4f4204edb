"""Small scenario driver: stored fixes and open trips kept as Python rows between runs."""

from __future__ import annotations

from dataclasses import dataclass, field

from geotrail.config import Params
from geotrail.plans.run import multiplexed, run_batch
from geotrail.schema import CAR_POSITIONS, COMPLETED_TRIPS, CURRENT_TRIPS, SPEED_ALERTS

STEP = 0.0001
LAT0, LON0 = 30.266, -97.73


def k(i: float, t: int):
    """Fix ``i`` steps north of the base point at time ``t`` ms (one step = 11.119 m)."""
    return (t, LAT0 + i * STEP, LON0)


def spike(t: int, lat: float = 31.0):
    return (t, lat, LON0)


@dataclass
class Fleet:
    spark: object
    params: Params = field(default_factory=Params)
    vin: str = "VIN000001"
    positions: list = field(default_factory=list)  # dicts of CAR_POSITIONS
    trips: list = field(default_factory=list)      # dicts of CURRENT_TRIPS
    completed: list = field(default_factory=list)
    alerts: list = field(default_factory=list)
    seq: int = 0

    def send(self, *fixes, vin: str | None = None):
        for t, lat, lon in fixes:
            self.seq += 1
            self.positions.append(
                dict(vin=vin or self.vin, timestamp=t, latitude=lat, longitude=lon, speed=0.0, engine_temp=0.0,
                     gas_tank_level=0.0, obd2_error_code="", processed=False, arrival_seq=self.seq)
            )

    def set_trip(self, **kw):
        self.trips = [kw]

    def run(self, as_of: int):
        sp = self.spark
        pos = sp.createDataFrame([tuple(r[f.name] for f in CAR_POSITIONS) for r in self.positions], CAR_POSITIONS)
        cur = sp.createDataFrame([tuple(r[f.name] for f in CURRENT_TRIPS) for r in self.trips], CURRENT_TRIPS)
        res = run_batch(pos, cur, as_of, self.params)
        rows = multiplexed(res).collect()  # all outputs in one job
        of = lambda kind, schema: [{f.name: r[f.name] for f in schema} for r in rows if r.kind == kind]
        marks = {(r.vin, r.timestamp, r.arrival_seq) for r in rows if r.kind == "processed"}
        for r in self.positions:
            if (r["vin"], r["timestamp"], r["arrival_seq"]) in marks:
                r["processed"] = True
        self.trips = of("current_trips", CURRENT_TRIPS)
        done = of("completed_trips", COMPLETED_TRIPS)
        al = of("speed_alerts", SPEED_ALERTS)
        self.completed += done
        self.alerts += al
        return dict(done=done, alerts=al, marks=marks)

    def unprocessed(self, vin: str | None = None):
        return {r["timestamp"] for r in self.positions if not r["processed"] and r["vin"] == (vin or self.vin)}

    def trip(self, vin: str | None = None):
        t = [r for r in self.trips if r["vin"] == (vin or self.vin)]
        assert len(t) <= 1
        return t[0] if t else None


def state_e(t: int) -> dict:
    """The reference tests' open trip E(T)."""
    return dict(vin="VIN000001", trip_start_timestamp=0, last_update_timestamp=t, start_lat=30.266, start_lon=-97.730,
                last_lat=30.2641, last_lon=-97.7283, total_distance_meters=10000.0, average_speed_kph=50.5,
                max_speed_kph=50.5, total_readings=3)
