"""Keyed-state trip fold over a stream of fixes.

One state per vehicle holds its open trip, or a pending lone fix that waits
for a partner (a run with a single fix and no trip does nothing). Each
micro-batch is one "run" for the vehicles that received fixes: rows are
sorted, late ones (at or before the open trip's last update) dropped, the
open trip's last point bridges to the new fixes, rejected segments are
skipped and accepted ones extend the trip. A state timer closes a trip once
``now - last update > timeout``; ``now`` is processing time, or the
watermark in event-time mode (deterministic replays).

Output rows are multiplexed by ``kind``: ``trip`` (the vehicle's open trip
after the batch, an upsert), ``completed`` and ``alert`` (appends), and on request ``outcome`` (one per message).

With ``dedupe`` a vehicle remembers the timestamps it has sent (:class:`geotrail.streaming.vehicle.Seen`), so a
copy is refused after its trip has closed too. A micro-batch's fixes of one vehicle need not fit a task:
they are sorted through keyed state (:mod:`geotrail.streaming.spill`) and folded array by array.

By default a stream consumes each fix once: fixes left unprocessed by a rejected segment are not retried in the next
batch (the batch run re-reads them, which can start "ghost" trips in the past). With ``retry`` they are kept
per vehicle and read again by its next run, and a vehicle with leftovers runs in every
micro-batch: the stream then equals the batch run, ghost trips included.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from geotrail.config import DEFAULT, DUPLICATE_MESSAGE, SAVED_MESSAGE, TOO_OLD_MESSAGE, Params
from geotrail.streaming.spill import BUFFER_ROWS, POINT, SEGMENT_ROWS, Segments, SegmentWriter, Sorter, merged
from geotrail.streaming.vehicle import REMEMBER_MS, SAVED, Run, Seen

TRIP_FIELDS = [
    ("trip_start_timestamp", T.LongType()),
    ("last_update_timestamp", T.LongType()),
    ("start_lat", T.DoubleType()),
    ("start_lon", T.DoubleType()),
    ("last_lat", T.DoubleType()),
    ("last_lon", T.DoubleType()),
    ("total_distance_meters", T.DoubleType()),
    ("average_speed_kph", T.DoubleType()),
    ("max_speed_kph", T.DoubleType()),
    ("total_readings", T.IntegerType()),
]
TRIP_NAMES = [n for n, _ in TRIP_FIELDS]

STATE_SCHEMA = T.StructType(
    [T.StructField("has_trip", T.BooleanType())]
    + [T.StructField(n, t) for n, t in TRIP_FIELDS]
    + [
        T.StructField("has_pending", T.BooleanType()),
        T.StructField("pending_ts", T.LongType()),
        T.StructField("pending_seq", T.LongType()),
        T.StructField("pending_lat", T.DoubleType()),
        T.StructField("pending_lon", T.DoubleType()),
    ]
)

OUTPUT_SCHEMA = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("vin", T.StringType())]
    + [T.StructField(n, t) for n, t in TRIP_FIELDS]
    + [
        T.StructField("duration_minutes", T.LongType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("computed_speed_kph", T.DoubleType()),
        T.StructField("speed_limit_kph", T.DoubleType()),
        T.StructField("arrival_seq", T.LongType()),
        T.StructField("saved", T.BooleanType()),
        T.StructField("message", T.StringType()),
    ]
)
OUT_NAMES = [f.name for f in OUTPUT_SCHEMA.fields]
# output rows on their way out of Python: few wide columns, because a frame per vehicle costs by its columns
PACKED_LONGS = [f.name for f in OUTPUT_SCHEMA if isinstance(f.dataType, (T.LongType, T.IntegerType, T.BooleanType))]
PACKED_DOUBLES = [f.name for f in OUTPUT_SCHEMA if isinstance(f.dataType, T.DoubleType)]
PACKED_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("kind", "vin", "message")]
    + [T.StructField("longs", T.ArrayType(T.LongType())), T.StructField("doubles", T.ArrayType(T.DoubleType()))]
)

DEG_TO_RAD = 0.017453292519943295
# what a vehicle's processor keeps beside the trip: where its leftovers lie, its newest timestamp, the oldest chunk it remembers
NOTES_SCHEMA = T.StructType([T.StructField(n, T.LongType()) for n in ("left_series", "left_segments", "newest", "oldest_chunk")])
SEGMENT_KEY = T.StructType([T.StructField("series", T.LongType()), T.StructField("number", T.LongType())])
CHUNK_KEY = T.StructType([T.StructField("chunk", T.LongType())])
BYTES = T.StructType([T.StructField("value", T.BinaryType())])
MESSAGES = (SAVED_MESSAGE, DUPLICATE_MESSAGE, TOO_OLD_MESSAGE)


def _r2(x: float) -> float:
    y = x * 100.0
    f = math.floor(y)
    return (f + (1 if y - f >= 0.5 else 0)) / 100.0


def _row(kind: str, vin: str, **kw) -> dict:
    r = {n: None for n in OUT_NAMES}
    r.update(kind=kind, vin=vin, **kw)
    return r


def packed_frame(rows: list[dict]) -> pd.DataFrame:
    """Output rows in ``PACKED_SCHEMA``; a NaN is a null, as in a pandas column."""
    return pd.DataFrame(
        {
            **{n: [r[n] for r in rows] for n in ("kind", "vin", "message")},
            "longs": [[None if r[n] is None else int(r[n]) for n in PACKED_LONGS] for r in rows],
            "doubles": [[None if r[n] is None or r[n] != r[n] else float(r[n]) for n in PACKED_DOUBLES] for r in rows],
        }
    )


def unpacked(out: DataFrame) -> DataFrame:
    """``PACKED_SCHEMA`` -> ``OUTPUT_SCHEMA``."""
    places = {n: F.col(column)[k] for column, names in (("longs", PACKED_LONGS), ("doubles", PACKED_DOUBLES)) for k, n in enumerate(names)}
    return out.select(*[places[f.name].cast(f.dataType).alias(f.name) if f.name in places else f.name for f in OUTPUT_SCHEMA])


def _completed(vin: str, trip: dict) -> dict:
    d = trip["last_update_timestamp"] - trip["trip_start_timestamp"]
    return _row("completed", vin, **{n: trip[n] for n in TRIP_NAMES}, duration_minutes=int(d / 60000))


def _points(batch: pd.DataFrame) -> np.ndarray:
    pts = np.empty(len(batch), POINT)
    for field, column in zip(POINT.names, ("timestamp", "arrival_seq", "latitude", "longitude")):
        pts[field] = batch[column].to_numpy()
    return pts


def _fold(vin: str, trip: dict, pts, p: Params) -> list[dict]:
    return fold_segments(vin, trip, np.asarray(pts, dtype=POINT), p)[0]


def fold_segments(vin: str, trip: dict, pts: np.ndarray, p: Params) -> tuple[list[dict], np.ndarray]:
    """Fold consecutive points (``POINT`` records) into ``trip`` (in place); returns alert rows and each segment's verdict.

    Distances, speeds and verdicts of all segments are computed as NumPy
    arrays; only the rounded running mean is a loop, and it stops at the
    fold horizon (after that many readings the mean cannot move).
    """
    if len(pts) < 2:
        return [], np.zeros(0, bool)
    ts, la, lo = pts["t"], pts["la"], pts["lo"]
    la1, la2 = la[:-1], la[1:]
    lo1, lo2 = lo[:-1], lo[1:]
    hd = ((la2 - la1) * DEG_TO_RAD) / 2
    hl = ((lo2 - lo1) * DEG_TO_RAD) / 2
    a = np.sin(hd) * np.sin(hd) + (np.cos(la1 * DEG_TO_RAD) * np.cos(la2 * DEG_TO_RAD)) * np.sin(hl) * np.sin(hl)
    with np.errstate(invalid="ignore"):
        m = (p.earth_radius_m * 2) * np.arctan2(np.sqrt(a), np.sqrt(1.0 - a))
        dt = (ts[1:] - ts[:-1]) / 1000.0
        v = np.where(dt <= 0, 0.0, (m / np.where(dt <= 0, 1.0, dt)) * 3.6)
        anomaly = np.isnan(v) | (v > p.anomaly_speed_kph)
        jump = (m > p.jump_distance_m) & (dt < p.jump_window_s)
    acc = ~anomaly & ~jump
    idx = np.flatnonzero(acc)
    if idx.size == 0:
        return [], acc
    n0 = trip["total_readings"]
    trip["total_distance_meters"] += float(m[idx].sum())
    trip["total_readings"] = n0 + int(idx.size)
    last = idx[-1] + 1
    trip["last_update_timestamp"], trip["last_lat"], trip["last_lon"] = int(ts[last]), float(la[last]), float(lo[last])
    vmax = float(v[idx].max())
    if vmax > trip["max_speed_kph"]:
        trip["max_speed_kph"] = _r2(vmax)
    avg, n = trip["average_speed_kph"], n0
    # a seed mean above the limit widens the horizon
    horizon = int(200.0 * max(p.anomaly_speed_kph, avg, 0.0)) + 1
    for x in v[idx][: max(horizon - n0, 0)]:
        n += 1
        avg = _r2((avg * (n - 1) + float(x)) / n)
    trip["average_speed_kph"] = avg
    fast = idx[v[idx] > p.speed_limit_kph]
    alerts = [
        _row("alert", vin, timestamp=int(ts[i + 1]), latitude=float(la[i + 1]), longitude=float(lo[i + 1]),
             computed_speed_kph=_r2(float(v[i])), speed_limit_kph=float(p.speed_limit_kph))
        for i in fast
    ]
    return alerts, acc


def _state_tuple(trip: dict | None, pending: tuple | None) -> tuple | None:
    if trip is None and pending is None:
        return None
    return (
        trip is not None,
        *[(trip or {}).get(n) for n in TRIP_NAMES],
        pending is not None,
        *(pending if pending is not None else (None, None, None, None)),
    )


def _from_state(st) -> tuple[dict | None, tuple | None]:
    if st is None:
        return None, None
    d = dict(zip(STATE_SCHEMA.fieldNames(), tuple(st)))
    trip = {n: d[n] for n in TRIP_NAMES} if d["has_trip"] else None
    pending = (d["pending_ts"], d["pending_seq"], d["pending_lat"], d["pending_lon"]) if d["has_pending"] else None
    return trip, pending


def _step(vin: str, st, batch: pd.DataFrame | None, now: int, p: Params, dedupe: bool = False) -> tuple[tuple | None, list[dict]]:
    """One vehicle, one micro-batch (``batch``) or one timer (``batch`` None): new state, output rows.

    The same rules as one batch run: late fixes dropped, the open trip's last
    point bridges to the new ones, a lone fix without trip waits, a trip with
    no new segment closes once ``now - last update > timeout``. With ``dedupe``
    the first arrival of each timestamp counts; copies of earlier fixes are late
    by the same rule as everything at or before the last update.
    """
    timeout = int(p.trip_timeout_ms)
    trip, pending = _from_state(st)
    out: list[dict] = []
    if batch is None:
        if trip is not None and now - trip["last_update_timestamp"] > timeout:
            out.append(_completed(vin, trip))
            trip = None
        return _state_tuple(trip, pending), out
    pts = _points(batch)
    had_trip = trip is not None
    if had_trip:
        lu = trip["last_update_timestamp"]
        bridge = np.array([(lu, -1, trip["last_lat"], trip["last_lon"])], POINT)
        pts = np.concatenate([bridge, pts[pts["t"] > lu]])
    elif pending is not None:
        pts = np.concatenate([np.array([pending], POINT), pts])
    pts = pts[np.lexsort((pts["s"], pts["t"]))]
    if dedupe and len(pts):
        pts = pts[np.append(True, pts["t"][1:] != pts["t"][:-1])]
    if len(pts) <= 1:
        if had_trip:
            if now - trip["last_update_timestamp"] > timeout:
                out.append(_completed(vin, trip))
                trip = None
            pending = None
        else:
            pending = pts[0].item() if len(pts) else None
        return _state_tuple(trip, pending), out
    if trip is None:
        t0, _, la, lo = pts[0].item()
        trip = dict(trip_start_timestamp=t0, last_update_timestamp=t0, start_lat=la, start_lon=lo,
                    last_lat=la, last_lon=lo, total_distance_meters=0.0, average_speed_kph=0.0,
                    max_speed_kph=0.0, total_readings=0)
    out += _fold(vin, trip, pts, p)
    out.append(_row("trip", vin, **trip))
    return _state_tuple(trip, None), out


def _make_func(p: Params, event_time: bool, grace: int, dedupe: bool):
    """Per-group function for ``applyInPandasWithState``."""
    timeout = int(p.trip_timeout_ms)

    def now_ms(state: GroupState) -> int:
        return int(state.getCurrentWatermarkMs() - grace if event_time else state.getCurrentProcessingTimeMs())

    def func(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        st = state.get if state.exists else None
        batch = None if state.hasTimedOut else pd.concat(list(pdfs), ignore_index=True)
        new, out = _step(key[0], st, batch, now_ms(state), p, dedupe)
        if new is None:
            state.remove()
        else:
            state.update(new)
            if new[0]:  # an open trip: check again once it may have timed out
                lu = new[1 + TRIP_NAMES.index("last_update_timestamp")]
                if event_time:
                    state.setTimeoutTimestamp(max(lu + timeout + 1, now_ms(state) + 1) + grace)
                else:
                    # due at the same instant as the timer form: after the last update, not after this batch
                    state.setTimeoutDuration(max(1, lu + timeout + 1 - now_ms(state)))
        if out:
            yield pd.DataFrame(out, columns=OUT_NAMES)

    return func


class TripProcessor(StatefulProcessor):
    """``transformWithStateInPandas`` form: a vehicle's trip, what it remembers, and one timer.

    The timer is due when the open trip may have timed out: at
    ``last update + timeout + 1`` on the watermark in event-time mode, and
    in processing-time mode at that instant or the next batch, whichever is
    later (the clock and the event times are unrelated, as in the original). With ``retry`` a vehicle with
    leftovers is due in every batch.
    """

    def __init__(self, p: Params, event_time: bool, grace: int, dedupe: bool, retry: bool = False, outcomes: bool = False,
                 remember_ms: int = REMEMBER_MS, buffer_rows: int = BUFFER_ROWS, segment_rows: int = SEGMENT_ROWS):
        self.p = p
        self.event_time = event_time
        self.grace = grace
        self.dedupe = dedupe
        self.retry = retry
        self.outcomes = outcomes
        self.remember_ms = remember_ms
        self.buffer_rows, self.segment_rows = buffer_rows, segment_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("trip", STATE_SCHEMA)
        self.notes = handle.getValueState("notes", NOTES_SCHEMA)
        self.seen = handle.getMapState("seen", CHUNK_KEY, BYTES)
        self.left = handle.getMapState("left", SEGMENT_KEY, BYTES)
        self.spill = handle.getMapState("spill", SEGMENT_KEY, BYTES)

    def _frame(self, out: list[dict]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=OUT_NAMES)

    def _now(self, tv) -> int:
        return int(tv.getCurrentWatermarkInMs() - self.grace if self.event_time else tv.getCurrentProcessingTimeInMs())

    def _save(self, new, now: int, left_segments: int, is_first: bool = False) -> None:
        if not is_first:    # a vehicle's first batch finds no timer
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
        if new is None:
            self.state.clear()
        else:
            self.state.update(new)
        due = None
        if left_segments:
            due = now + 1
        elif new is not None and new[0]:
            lu = new[1 + TRIP_NAMES.index("last_update_timestamp")]
            due = max(lu + int(self.p.trip_timeout_ms) + 1, now + 1)
        if due is not None:
            self.handle.registerTimer(due + (self.grace if self.event_time else 0))

    def _fresh(self, points: Iterator[np.ndarray], notes: dict, out: list[dict], vin: str) -> Iterator[np.ndarray]:
        """First arrivals among sorted fixes; message outcomes go to ``out``."""
        seen = Seen(self.seen, self.p.chunk_ms, self.remember_ms)
        before, newest = notes["newest"], notes["newest"]
        for part in points:
            found = seen.outcomes(part, before)
            newest = int(part["t"][-1]) if newest is None else max(newest, int(part["t"][-1]))
            if self.outcomes:
                out += [
                    _row("outcome", vin, timestamp=int(t), arrival_seq=int(s), saved=bool(f == SAVED), message=MESSAGES[f])
                    for t, s, f in zip(part["t"], part["s"], found)
                ]
            yield part[found == SAVED]
        if newest is not None:
            notes["newest"], notes["oldest_chunk"] = newest, seen.forget(newest, notes["oldest_chunk"])

    def _run(self, vin: str, fresh: Iterator[np.ndarray], notes: dict, out: list[dict], now: int) -> Iterator[pd.DataFrame]:
        """One run of the vehicle: leftovers or the pending fix, and the new fixes, in one ordered stream."""
        trip, pending = _from_state(self.state.get() if self.state.exists() else None)
        segments, writer, old = Segments(self.left), None, iter(())
        series, count = notes["left_series"], notes["left_segments"]
        if self.retry:
            old, writer = segments.read(series, count), SegmentWriter(segments, 1 - series, self.segment_rows)
        elif pending is not None and trip is None:
            old = iter([np.array([pending], POINT)])
        run = Run(vin, trip, self.p, writer)
        for points in merged([fresh, old]):
            for at in range(0, len(points), self.segment_rows):
                out += run.feed(points[at : at + self.segment_rows])
                if len(out) >= self.segment_rows:
                    yield self._frame(out)
                    out.clear()
        had_trip = trip is not None
        trip, gated_in, lone = run.finish()
        if gated_in:
            out.append(_row("trip", vin, **trip))
        elif had_trip and now - trip["last_update_timestamp"] > int(self.p.trip_timeout_ms):
            out.append(_completed(vin, trip))
            trip = None
        if self.retry:
            segments.drop(series, count)
            notes["left_series"], notes["left_segments"] = 1 - series, writer.close()
            lone = None
        self._save(_state_tuple(trip, None if lone is None else lone[0].item()), now, notes["left_segments"], notes["is_first"])
        self.notes.update(tuple(notes[f.name] for f in NOTES_SCHEMA))
        if out:
            yield self._frame(out)

    def _read_notes(self) -> dict:
        names = NOTES_SCHEMA.fieldNames()
        is_first = not self.notes.exists()
        return {**dict(zip(names, (0, 0, None, None) if is_first else tuple(self.notes.get()))), "is_first": is_first}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        notes, out = self._read_notes(), []
        sorter = Sorter(Segments(self.spill), self.buffer_rows, self.segment_rows)
        for batch in rows:
            sorter.add(_points(batch))
        fresh = sorter.sorted()
        if self.dedupe:
            fresh = self._fresh(fresh, notes, out, key[0])
        yield from self._run(key[0], fresh, notes, out, self._now(timerValues))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = self._now(timerValues)
        if self.retry:
            yield from self._run(key[0], iter(()), self._read_notes(), [], now)
            return
        st = self.state.get() if self.state.exists() else None
        new, out = _step(key[0], st, None, now, self.p)
        self._save(new, now, 0)
        if out:
            yield self._frame(out)

    def close(self) -> None:
        pass


class PackedTripProcessor(TripProcessor):
    """The same, with its output rows packed (:func:`unpacked` gives ``OUTPUT_SCHEMA``)."""

    def _frame(self, out: list[dict]) -> pd.DataFrame:
        return packed_frame(out)


# how far a vehicle's event time may lie behind the fleet's: ten years
MAX_LAG_DAYS = 3650
MAX_LAG_MS = MAX_LAG_DAYS * 86_400_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def trip_stream(
    fixes: DataFrame,
    p: Params = DEFAULT,
    event_time: bool = False,
    watermark: str = "10 minutes",
    api: str = "transformWithState",
    dedupe: bool = False,
    **options,
) -> DataFrame:
    """Streaming fixes in ``car_positions`` shape -> multiplexed trip outputs.

    Keyed by ``vin``: Spark hash-partitions the stream on the key and keeps
    one small state per vehicle. ``api`` picks ``transformWithState`` (value
    state + timers; needs the RocksDB state store, see :func:`write_trip_stream`)
    or the older ``applyInPandasWithState`` (state timeouts).

    In event-time mode the fleet's newest event time, less ``watermark``, is the
    clock of the timers and nothing else: Spark's own watermark trails so far behind
    (``MAX_LAG_DAYS``) that a vehicle whose clock or connection lags the
    fleet keeps all its fixes; late is only what lies at or before its own last update.

    ``options`` of the ``transformWithState`` form: ``retry`` (leftovers are run again), ``outcomes`` (a row per message, with
    ``dedupe``), ``remember_ms``, ``buffer_rows``. The older form keeps no memory of copies
    beyond the open trip and holds a vehicle's rows of a micro-batch together; it takes none of them.
    """
    grace = int(pd.Timedelta(watermark).total_seconds() * 1000)
    cols = fixes.select("vin", "timestamp", "latitude", "longitude", F.coalesce(F.col("arrival_seq"), F.lit(0)).alias("arrival_seq"))
    if event_time:
        # shifted ahead by the same delay, so the watermark's value is the newest event time
        cols = cols.withColumn("_et", F.timestamp_millis(F.col("timestamp") + F.lit(MAX_LAG_MS))).withWatermark("_et", f"{MAX_LAG_DAYS} days")
    if api == "transformWithState":
        out = cols.groupBy("vin").transformWithStateInPandas(
            statefulProcessor=PackedTripProcessor(p, event_time, grace, dedupe, **options),
            outputStructType=PACKED_SCHEMA,
            outputMode="Append",
            timeMode="EventTime" if event_time else "ProcessingTime",
        )
        return unpacked(out)
    if options:
        raise ValueError(f"{sorted(options)} need transformWithState")
    conf = GroupStateTimeout.EventTimeTimeout if event_time else GroupStateTimeout.ProcessingTimeTimeout
    return cols.groupBy("vin").applyInPandasWithState(_make_func(p, event_time, grace, dedupe), OUTPUT_SCHEMA, STATE_SCHEMA, "append", conf)


def write_trip_stream(out: DataFrame, root: str, checkpoint: str, trigger: dict | None = None):
    """Sink: each micro-batch appended under ``kind=`` folders with its batch id, and the open trips kept beside it.

    ``trip`` rows are versions; the open-trip table is the latest version per
    vehicle not followed by a ``completed`` row (:class:`geotrail.streaming.snapshot.OpenTrips` holds it up to date).
    Appends are idempotent per batch id (a replayed batch overwrites its own folder). A new checkpoint counts
    batches from zero again, so it needs an output root of its own.
    """
    from geotrail.streaming.snapshot import OpenTrips

    open_now = OpenTrips(out.sparkSession, root)
    if open_now.origin() not in (None, checkpoint):
        raise ValueError(f"{root} holds the output of another checkpoint")

    def sink(batch: DataFrame, batch_id: int):
        path = f"{root}/batch_id={batch_id}"
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").partitionBy("kind").parquet(path)
        # from what was written: the stateful operator runs once per batch
        schema = T.StructType([*OUTPUT_SCHEMA.fields, T.StructField("batch_id", T.LongType())])
        written = batch.sparkSession.read.schema(schema).parquet(path)
        open_now.merge(written, batch_id, checkpoint)

    trig = trigger or {"availableNow": True}
    w = out.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**trig)
    spark = out.sparkSession
    settings = {}
    # transformWithState keeps its state in RocksDB; the provider is fixed when
    # the query starts (and recorded in its checkpoint)
    settings["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB
    if "availableNow" in trig or "once" in trig:
        # a bounded run: processing-time timers would otherwise schedule empty
        # micro-batches forever
        settings["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        return w.start()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def open_trips(outputs: DataFrame) -> DataFrame:
    """Current open trips from accumulated stream outputs (latest event per vehicle)."""
    ev = outputs.filter(F.col("kind").isin("trip", "completed"))
    last = ev.groupBy("vin").agg(F.max_by(F.struct(*[F.col(c) for c in ["kind"] + TRIP_NAMES]), F.struct("batch_id", F.col("kind") == "completed")).alias("l"))
    return last.filter(F.col("l.kind") == "trip").select("vin", *[F.col(f"l.{c}").alias(c) for c in TRIP_NAMES])


def trip_stream_from_raw(raw: DataFrame, root: str, checkpoint: str, p: Params = DEFAULT, trigger: dict | None = None, **options):
    """Inbound messages -> normalise (I1) -> keyed first-arrival dedupe and trip fold
    -> multiplexed sink. Returns the started query.

    There is no fleet-wide watermark on the data: copies are told apart per vehicle, by the timestamps it
    remembers, whether its trip is open or closed. ``options`` go to :func:`trip_stream`.
    """
    from geotrail.sources.ingest import normalize

    return write_trip_stream(trip_stream(normalize(raw), p, dedupe=True, **options), root, checkpoint, trigger)


def ingest_to_store(raw: DataFrame, store, checkpoint: str, trigger: dict | None = None):
    """Inbound messages -> normalise -> exact first-arrival dedupe -> the store's fixes.

    Each micro-batch is deduplicated by arrival order and anti-joined with the
    stored keys of the dates it touches, then appended; a replayed batch finds
    its rows already stored, so the sink is idempotent.
    """
    def sink(batch: DataFrame, batch_id: int):
        store.append_positions(batch)

    w = raw.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()
