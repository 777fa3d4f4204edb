"""One vehicle, one micro-batch: first arrivals, the run's rules and the fold, over sorted streams of fixes.

Nothing here holds a micro-batch: fixes come as sorted arrays (:mod:`geotrail.streaming.spill`) and leave
as folded trips, alerts and leftovers, array by array. State is reached through three map states:

``seen``
    timestamps taken in, per time chunk: a copy of a fix is refused for good, whatever has become of its trip. A vehicle remembers
    ``remember_ms`` back from its newest fix; what is older than that is refused without being looked up, so
    forgetting never lets a copy in.
``left``
    fixes that a run leaves unprocessed (late ones, starts of rejected segments, a lone fix): the retry mode's
    next run reads them again, as the batch run does.
``spill``
    sorted runs of a micro-batch that doesn't fit the buffer; empty between batches.
"""

from __future__ import annotations

import numpy as np

from geotrail.config import Params
from geotrail.streaming.spill import POINT, SegmentWriter

REMEMBER_MS = 30 * 86_400_000
SAVED, DUPLICATE, TOO_OLD = range(3)


class Seen:
    """Which timestamps a vehicle has sent before."""

    def __init__(self, state, chunk_ms: int, remember_ms: int = REMEMBER_MS):
        self.state, self.chunk_ms, self.remember_ms = state, int(chunk_ms), int(remember_ms)

    def outcomes(self, points: np.ndarray, newest: int | None) -> np.ndarray:
        """SAVED / DUPLICATE / TOO_OLD per point (sorted by time and arrival); saved ones are remembered.

        ``newest`` is the vehicle's newest timestamp before the batch.
        """
        t = points["t"]
        out = np.where(np.append(False, t[1:] == t[:-1]), DUPLICATE, SAVED)
        chunk = t // self.chunk_ms
        for c in np.unique(chunk):
            here = np.flatnonzero(chunk == c)
            known = self._times(int(c))
            old = np.isin(t[here], known)
            out[here[old]] = DUPLICATE
            if newest is not None:
                out[here[t[here] < newest - self.remember_ms]] = TOO_OLD
            new = t[here[out[here] == SAVED]]
            if len(new):
                self.state.updateValue((int(c),), (np.union1d(known, new).astype("<i8").tobytes(),))
        return out

    def _times(self, chunk: int) -> np.ndarray:
        if not self.state.containsKey((chunk,)):
            return np.empty(0, "<i8")
        return np.frombuffer(bytes(self.state.getValue((chunk,))[0]), "<i8")

    def forget(self, newest: int, oldest_chunk: int | None) -> int:
        """Drop chunks that lie wholly before the memory; returns the first chunk that may be kept."""
        first = (newest - self.remember_ms) // self.chunk_ms
        if oldest_chunk is not None and first <= oldest_chunk:
            return oldest_chunk
        for key in [k for k in self.state.keys() if k[0] < first]:
            self.state.removeKey(key)
        return first


class Run:
    """The rules of one run (F2, F6, W1-W3, F3-F5, A6-A11) over a sorted stream of a vehicle's fixes.

    ``feed`` takes arrays in order and yields alert rows; ``finish`` returns the open trip (or None), whether
    the gate was passed, and the lone fix that waits. With ``left`` (a :class:`SegmentWriter`) fixes the run doesn't process go there.
    """

    def __init__(self, vin: str, trip: dict | None, p: Params, left: SegmentWriter | None = None):
        self.vin, self.trip, self.p, self.left = vin, trip, p, left
        self.had_trip = trip is not None
        self.bridge_ts = trip["last_update_timestamp"] if trip else None
        self.before: np.ndarray | None = None    # the fix before the next one
        self.n = 0                                # rows that count for the gate
        if trip:
            self.before = np.array([(self.bridge_ts, -1, trip["last_lat"], trip["last_lon"])], POINT)
            self.n = 1
        self.stored = False                       # ``before`` is a fix of its own, not the bridge

    def feed(self, points: np.ndarray) -> list[dict]:
        from geotrail.streaming.stateful import fold_segments

        if self.bridge_ts is not None:
            late = points["t"] <= self.bridge_ts
            if self.left is not None and late.any():
                self.left.add(points[late])
            points = points[~late]
        if not len(points):
            return []
        track = points if self.before is None else np.concatenate([self.before, points])
        self.n += len(points)
        alerts: list[dict] = []
        if len(track) > 1:
            if self.trip is None:
                t0, _, la, lo = track[0].item()
                self.trip = dict(trip_start_timestamp=t0, last_update_timestamp=t0, start_lat=la, start_lon=lo, last_lat=la, last_lon=lo,
                                 total_distance_meters=0.0, average_speed_kph=0.0, max_speed_kph=0.0, total_readings=0)
            alerts, accepted = fold_segments(self.vin, self.trip, track, self.p)
            if self.left is not None:
                starts = track[:-1]
                keep = ~accepted
                if self.before is not None and not self.stored:
                    keep[0] = False  # the bridge is no stored fix
                self.left.add(starts[keep])
        self.before, self.stored = track[-1:], True
        return alerts

    def finish(self) -> tuple[dict | None, bool, np.ndarray | None]:
        gated_in = self.n >= 2
        lone = self.before if not gated_in and not self.had_trip and self.before is not None else None
        if lone is not None and self.left is not None:
            self.left.add(lone)
        return self.trip, gated_in, lone

