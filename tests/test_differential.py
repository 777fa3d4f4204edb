"""run_batch against a naive row-by-row simulation over random multi-run scenarios."""

import copy
import random

import pytest

from geotrail.config import Params
from tests.helpers import Fleet
from tests.sim import run_once

LATS = [30.266, 30.2661, 30.2663, 30.2668, 30.27, 30.3, 31.0]


def _eq(a, b):
    return a == b if isinstance(b, str) else a == pytest.approx(b, rel=1e-12, abs=1e-9)


def _scenario(seed):
    rnd = random.Random(seed)
    vins = [f"V{i}" for i in range(rnd.randint(1, 3))]
    runs, t_max = [], 0
    for _ in range(rnd.randint(2, 4)):
        batch = []
        for _ in range(rnd.randint(0, 7)):
            vin = rnd.choice(vins)
            if t_max and rnd.random() < 0.25:
                t = rnd.randint(0, t_max)  # late or out of order
            else:
                t = t_max + rnd.choice([0, 1000, 1000, 2000, 5000, 400_000])
            t_max = max(t_max, t)
            batch.append((vin, t, rnd.choice(LATS), -97.73 + rnd.choice([0.0, 0.0001, 0.01])))
        as_of = t_max + rnd.choice([1, 1000, 299_999, 300_001, 900_000])
        t_max = as_of
        runs.append((batch, as_of))
    return runs


@pytest.mark.parametrize("seed", range(12))
def test_run_batch_equals_simulation(spark, seed):
    p = Params(chunk_ms=[1, 2000, 3_600_000][seed % 3])
    f = Fleet(spark, params=p)
    sim_pos, sim_trips = [], {}
    for batch, as_of in _scenario(seed):
        for vin, t, lat, lon in batch:
            f.send((t, lat, lon), vin=vin)
        sim_pos = copy.deepcopy(f.positions) if not sim_pos else sim_pos + copy.deepcopy(f.positions[len(sim_pos):])
        got = f.run(as_of)
        want = run_once(sim_pos, sim_trips, as_of, p)
        assert sorted((a["vin"], a["timestamp"], a["computed_speed_kph"]) for a in got["alerts"]) == sorted(want["alerts"])
        assert {(r["vin"], r["timestamp"], r["arrival_seq"]) for r in f.positions if r["processed"]} == {
            (r["vin"], r["timestamp"], r["arrival_seq"]) for r in sim_pos if r["processed"]
        }
        assert sorted(t["vin"] for t in f.trips) == sorted(sim_trips)
        for t in f.trips:
            s = sim_trips[t["vin"]]
            for c, v in s.items():
                assert _eq(t[c], v), (c, as_of)
        assert len(got["done"]) == len(want["done"])
        for d, w in zip(sorted(got["done"], key=lambda x: x["vin"]), sorted(want["done"], key=lambda x: x["vin"])):
            for c, v in w.items():
                assert _eq(d[c], v), (c, as_of)
