"""Sorted access to one vehicle's fixes of a micro-batch in bounded memory.

A micro-batch may bring more fixes of one vehicle than a task can hold (a feed that was
down for a day, a first start over a backlog). They arrive in Arrow batches, in no order. :class:`Sorter` keeps at most
``buffer_rows`` of them; each full buffer is sorted and put aside as a *run* of segments in keyed
state (the state store spills to disk and is rolled back with a failed batch), and the runs are merged segment by segment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# one fix inside a task: time, arrival, latitude, longitude
POINT = np.dtype([("t", "i8"), ("s", "i8"), ("la", "f8"), ("lo", "f8")])
BUFFER_ROWS = 262_144   # fixes of one vehicle held in memory (8 MB)
SEGMENT_ROWS = 8_192    # fixes of one state value (256 kB)


def ordered(points: np.ndarray) -> np.ndarray:
    """By time, then arrival."""
    return points[np.lexsort((points["s"], points["t"]))]


def _upto(points: np.ndarray, t: int, s: int) -> int:
    """Number of leading points at or before ``(t, s)``."""
    lo, hi = np.searchsorted(points["t"], t, "left"), np.searchsorted(points["t"], t, "right")
    return int(lo + np.searchsorted(points["s"][lo:hi], s, "right"))


def merged(streams: list[Iterator[np.ndarray]]) -> Iterator[np.ndarray]:
    """Merge streams of sorted arrays into one; holds one array per stream."""
    heads: list[np.ndarray] = []
    rest: list[Iterator[np.ndarray]] = []
    for stream in streams:
        first = _next(stream)
        if first is not None:
            heads.append(first)
            rest.append(stream)
    while heads:
        # all that lies at or before the earliest end of a head can be told to be complete
        t, s = min((int(h["t"][-1]), int(h["s"][-1])) for h in heads)
        cut = [_upto(h, t, s) for h in heads]
        out = [h[:c] for h, c in zip(heads, cut) if c]
        yield ordered(np.concatenate(out)) if len(out) > 1 else out[0]
        heads = [h[c:] for h, c in zip(heads, cut)]
        for i in range(len(heads) - 1, -1, -1):
            if not len(heads[i]):
                more = _next(rest[i])
                if more is None:
                    del heads[i], rest[i]
                else:
                    heads[i] = more


def _next(stream: Iterator[np.ndarray]) -> np.ndarray | None:
    for points in stream:
        if len(points):
            return points
    return None


class Segments:
    """Numbered arrays of points in a keyed map state: ``(series, number) -> bytes``."""

    def __init__(self, state):
        self.state = state

    def put(self, series: int, number: int, points: np.ndarray) -> None:
        self.state.updateValue((series, number), (points.tobytes(),))

    def read(self, series: int, count: int) -> Iterator[np.ndarray]:
        for number in range(count):
            yield np.frombuffer(bytes(self.state.getValue((series, number))[0]), POINT)

    def drop(self, series: int, count: int) -> None:
        for number in range(count):
            self.state.removeKey((series, number))


class SegmentWriter:
    """Writes a stream of points as one series of full segments."""

    def __init__(self, segments: Segments, series: int, segment_rows: int = SEGMENT_ROWS):
        self.segments, self.series, self.rows = segments, series, segment_rows
        self.held: list[np.ndarray] = []
        self.n_held = self.count = self.total = 0

    def add(self, points: np.ndarray) -> None:
        self.held.append(points)
        self.n_held += len(points)
        self.total += len(points)
        if self.n_held >= self.rows:
            self._flush(self.n_held - self.n_held % self.rows)

    def _flush(self, rows: int) -> None:
        points = np.concatenate(self.held) if self.held else np.empty(0, POINT)
        for at in range(0, rows, self.rows):
            self.segments.put(self.series, self.count, points[at : at + self.rows])
            self.count += 1
        self.held, self.n_held = [points[rows:]], len(points) - rows

    def close(self) -> int:
        """Number of segments written."""
        if self.n_held:
            self._flush(self.n_held)
        return self.count


class Sorter:
    """Points in any order -> sorted arrays, with at most ``buffer_rows`` in memory."""

    def __init__(self, segments: Segments, buffer_rows: int = BUFFER_ROWS, segment_rows: int = SEGMENT_ROWS):
        self.segments, self.buffer_rows, self.segment_rows = segments, buffer_rows, segment_rows
        self.held: list[np.ndarray] = []
        self.n_held = 0
        self.runs: list[int] = []   # segments per run

    def add(self, points: np.ndarray) -> None:
        for at in range(0, len(points), self.buffer_rows):
            part = points[at : at + self.buffer_rows]
            if self.n_held + len(part) > self.buffer_rows:
                self._spill()
            self.held.append(part)
            self.n_held += len(part)

    def _spill(self) -> None:
        writer = SegmentWriter(self.segments, len(self.runs), self.segment_rows)
        writer.add(ordered(np.concatenate(self.held)))
        self.runs.append(writer.close())
        self.held, self.n_held = [], 0

    def sorted(self) -> Iterator[np.ndarray]:
        """All points in order; what was put aside is removed from the state afterwards."""
        last = [ordered(np.concatenate(self.held))] if self.held else []
        if not self.runs:
            yield from last
            return
        yield from merged([*(self.segments.read(run, count) for run, count in enumerate(self.runs)), iter(last)])
        for run, count in enumerate(self.runs):
            self.segments.drop(run, count)
