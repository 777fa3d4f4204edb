"""The ordered, rounded running mean (A9): a fold, and the maps that let parts of it be computed apart.

``avg = r2((avg * (n - 1) + v) / n)`` after each reading ``v`` depends on the order of all readings
before it. But after one step the mean lies on a grid: ``k / 100`` for whole ``k`` from 0 to 100 times the
largest accepted speed (30 001 values by default), and a step is a monotone map of that grid. So a block of readings
is one map, computed wherever its readings lie once their number ``n`` before the block is known; maps of
consecutive blocks compose by lookup, and composition is associative.

A map is needed only on the values the mean can have when the block begins. Rounding moves it by at most 0.005 per
step, so ``n * mean`` differs from the plain sum of the readings by at most ``0.005 * (1 + ... + n)``: after ``n`` readings the mean lies
within ``0.0025 * (n + 1)`` of the plain mean, which is ``(n + 1) / 2`` grid values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from geotrail.functions.geo import java_round2

GRID = 100          # grid values per km/h: the mean has two decimals
MERGE_EVERY = 64    # steps between two looks for values that have met


def rounded_mean_fold(sorted_speeds: Column, seed_n: Column, seed_avg: Column) -> Column:
    """Fold ``avg = r2((avg * (n - 1) + v) / n)`` over an ordered array of speeds.

    Rounding at every step makes the result order dependent (it drifts and
    sticks), so this is a left fold, not ``avg()``. Returns the final mean;
    with an empty array the seed mean comes back unchanged.
    """
    init = F.struct(seed_n.cast("int").alias("n"), seed_avg.cast("double").alias("avg"))

    def step(acc, v):
        n = acc["n"] + 1
        return F.struct(n.alias("n"), java_round2((acc["avg"] * acc["n"] + v) / n).alias("avg"))

    return F.aggregate(sorted_speeds, init, step)["avg"]


def through_maps(mean: Column, maps: Column) -> Column:
    """``mean`` (a grid value) sent through consecutive block maps ``array<struct<block, lo, map>>``."""
    start = F.round(mean * GRID).cast("int")
    end = F.aggregate(maps, start, lambda k, m: F.element_at(m["map"], k - m["lo"] + 1))
    return F.when(maps.isNull() | (F.size(maps) == 0), mean).otherwise(end / F.lit(float(GRID)))


def possible_means(total: float, n: int, top: float) -> tuple[int, int]:
    """First and last grid value the mean can have after ``n`` readings of sum ``total``, all between 0 and ``top``."""
    highest = int(np.ceil(top * GRID)) + 1
    if n <= 0:
        return 0, highest
    mean, reach = total / n, 0.0025 * (n + 1)
    # one value of slack: the bounds are computed in floating point
    return max(int(np.floor((mean - reach) * GRID)) - 1, 0), min(int(np.ceil((mean + reach) * GRID)) + 1, highest)


def block_map(speeds: np.ndarray, n: int, lo: int, hi: int) -> np.ndarray:
    """Grid value after the readings ``speeds`` for every grid value ``lo..hi`` before them, ``n`` readings in.

    The arithmetic is that of :func:`rounded_mean_fold`, on all values at once. The map is
    monotone, so values that have met are neighbours and go on as one.
    """
    k = np.arange(lo, hi + 1, dtype=np.float64)
    where = np.arange(len(k))
    for i, v in enumerate(speeds):
        y = (k / 100.0 * n + v) / (n + 1) * 100.0
        n += 1
        k = np.floor(y)
        k += y - k >= 0.5
        if i % MERGE_EVERY == MERGE_EVERY - 1 and len(k) > 1:
            new = np.append(True, k[1:] != k[:-1])
            if not new.all():
                where = (np.cumsum(new) - 1)[where]
                k = k[new]
    return k[where].astype(np.int32)


def composed(first_lo: int, first: np.ndarray, second_lo: int, second: np.ndarray) -> tuple[int, np.ndarray]:
    """The map of two consecutive blocks, on the values where the first is known."""
    return first_lo, second[first - second_lo]


MAPS_SCHEMA = pa.schema([("vin", pa.string()), ("trip_no", pa.int64()), ("fold_block", pa.int64()), ("lo", pa.int32()), ("map", pa.list_(pa.int32()))])
MAPS_DDL = "vin string, trip_no long, fold_block long, lo int, map array<int>"


def block_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``vin, trip_no, fold_block, n, total, top, v`` (one block of speeds a row) -> its map, row by row."""
    for batch in batches:
        for i in range(batch.num_rows):
            vin, trip_no, block, n, total, top = (batch.column(c)[i].as_py() for c in ("vin", "trip_no", "fold_block", "n", "total", "top"))
            lo, hi = possible_means(total, n, top)
            ends = block_map(batch.column("v")[i].values.to_numpy(zero_copy_only=False), n, lo, hi)
            columns = [[vin], [trip_no], [block], [lo], pa.ListArray.from_arrays(np.array([0, len(ends)], np.int32), pa.array(ends))]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, MAPS_SCHEMA)], schema=MAPS_SCHEMA)
