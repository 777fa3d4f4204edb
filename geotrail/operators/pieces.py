"""Trips as sums of pieces: the ordered roll-up (A6-A11) without a vehicle in one task.

The rows are shuffled and sorted once, on ``(vin, chunk)``, and reduced there to *pieces*: the fixes of one
chunk and one trip, with at most ``Params.fold_block`` accepted speeds as plain doubles. From then on only pieces move:

1. to ``(vin, span)`` (``SPAN`` chunks): speeds that come after the trip's fold horizon are dropped, so a
   vehicle keeps at most one horizon of them per span, whatever its rows;
2. to ``vin``: the segment that enters each chunk, trip numbers, and the number and sum of the trip's readings before each piece;
3. readings before a piece, cut by ``fold_block``, make *blocks*. The first block of a trip is folded as it is; each later one goes
   to a task of its own, ``(vin, trip, block)``, and returns as a map of the mean's grid
   (:mod:`geotrail.functions.fold`). A trip looks its mean up in at most horizon / ``fold_block`` maps.

No row meets a summary, no array exceeds two blocks of speeds or one grid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from geotrail.config import Params
from geotrail.functions.fold import MAPS_DDL, block_maps
from geotrail.operators import chunked
from geotrail.operators.segments import measured

SPAN = 1024                                # chunks whose pieces meet in one task first
ORDER = ("chunk", "part", "block")         # order of a vehicle's pieces
TRIP = ("vin", "trip_no")


def horizon(p: Params, seed_avg: Column | None = None) -> Column:
    """Reading count after which a trip's rounded mean cannot move (see ``Params.fold_horizon``).

    Speeds and mean lie below the larger of the anomaly limit and the open trip's mean, which
    exceeds the limit when that was lowered between runs.
    """
    if seed_avg is None:
        return F.lit(p.fold_horizon).cast("long")
    return F.floor(F.greatest(F.lit(max(p.anomaly_speed_kph, 0.0)), F.coalesce(seed_avg, F.lit(0.0))) * 200.0) + 1


def _in_order(wanted: Column, order: tuple[str, ...], value: str) -> Column:
    """The group's ``value`` where ``wanted`` holds, in order."""
    found = F.collect_list(F.when(wanted, F.struct(*[F.col(c) for c in order], F.col(value).alias("v"))))
    return F.transform(F.array_sort(found), lambda x: x["v"])


def chunk_pieces(rows: DataFrame, p: Params, gap_ms: int | None = None) -> DataFrame:
    """Reduce rows with ``prev`` (see :mod:`chunked`) to pieces where they lie.

    ``part`` counts the breaks (gaps above ``gap_ms``) inside the chunk, ``block`` its accepted segments in
    steps of ``fold_block``. ``horizon``, if among the columns, overrides the parameters'.
    """
    w = Window.partitionBy("vin", "chunk").orderBy("ts", "seq").rowsBetween(chunked.UNB, chunked.CUR)
    prev = F.col("prev")
    gap = F.lit(False) if gap_ms is None else prev.isNotNull() & (F.col("ts") - prev["ts"] > F.lit(gap_ms))
    d = measured(rows.withColumn("gap", gap), p, prev.isNotNull() & ~F.col("gap"))
    d = d.withColumn("part", F.sum(F.col("gap").cast("long")).over(w)).withColumn("rank", F.sum("accepted").over(w))
    # readings of the trip in this chunk up to the row: a break has none, so the rank at the last one comes off
    since = F.col("rank") - F.coalesce(F.max(F.when(F.col("gap"), F.col("rank"))).over(w), F.lit(0))
    limit = F.col("horizon") if "horizon" in rows.columns else horizon(p)
    acc = F.col("accepted") == 1
    d = d.withColumn("folded", acc & (since <= limit))
    d = d.withColumn("block", F.floor((F.greatest("rank", F.lit(1)) - 1) / F.lit(p.fold_block)))
    return d.groupBy("vin", *ORDER).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.col("is_bridge").cast("int")).alias("has_bridge"),
        F.max(F.col("gap").cast("int")).alias("opens"),
        F.min(chunked.point()).alias("first"),
        F.max(chunked.point()).alias("last"),
        F.max(F.when(acc, chunked.point())).alias("last_acc"),
        F.coalesce(F.sum(F.when(acc, F.col("seg_m"))), F.lit(0.0)).alias("m"),
        F.coalesce(F.sum(F.when(acc, F.col("seg_kph"))), F.lit(0.0)).alias("kph"),
        F.sum("accepted").cast("long").alias("acc_n"),
        F.max(F.when(acc, F.col("seg_kph"))).alias("top"),
        _in_order(F.col("folded"), ("ts", "seq"), "seg_kph").alias("v"),
    )


def _first_of_chunk() -> Column:
    return (F.col("part") == 0) & (F.col("block") == 0)


def _gap_before(previous: Column, gap_ms: int | None) -> Column:
    if gap_ms is None:
        return F.lit(False)
    return F.coalesce(_first_of_chunk() & (F.col("first")["ts"] - previous["ts"] > F.lit(gap_ms)), F.lit(False))


def without_settled(pieces: DataFrame, p: Params, gap_ms: int | None, limit: Column) -> DataFrame:
    """Drop speeds that come after the trip's horizon within their span of chunks.

    What is counted here (readings inside chunks, since the last break seen) is never more than
    the trip's true count, so nothing is dropped that could still move the mean.
    """
    # nothing is confined to ``vin`` yet: a vehicle's spans go to tasks of their own
    s = pieces.withColumn("span", F.floor(F.col("chunk") / (chunked.width(p) * SPAN)))
    w = Window.partitionBy("vin", "span").orderBy(*ORDER)
    before = F.coalesce(F.sum("acc_n").over(w.rowsBetween(chunked.UNB, -1)), F.lit(0))
    s = s.withColumn("before", before)
    s = s.withColumn("begins", (F.col("opens") == 1) | _gap_before(F.lag("last").over(w), gap_ms))
    base = F.coalesce(F.max(F.when(F.col("begins"), F.col("before"))).over(w.rowsBetween(chunked.UNB, chunked.CUR)), F.lit(0))
    s = s.withColumn("base", base)
    kept = F.when(F.col("before") - F.col("base") < limit, F.col("v")).otherwise(F.array().cast("array<double>"))
    return s.withColumn("v", kept).drop("span", "before", "base", "begins")


def placed(pieces: DataFrame, p: Params, gap_ms: int | None = None, entered: bool = False, seeds: DataFrame | None = None) -> DataFrame:
    """Pieces with their trip number and what the trip holds before them.

    Adds ``trip_no``, ``n0`` / ``kph0`` (readings of the trip before the piece and their sum, without the open
    trip's), ``fold_block`` and ``limit`` (the trip's horizon). The segment that enters a chunk is measured here from
    the pieces on both sides, unless the rows had their neighbours already (``entered``).
    ``seeds`` (one row per vehicle, see ``segments.seed_table``) adds ``seed_n`` and ``seed_avg``.
    """
    if seeds is None:
        s = pieces.withColumns({"seed_n": F.lit(0).cast("long"), "seed_avg": F.lit(0.0)})
        s = without_settled(s, p, gap_ms, horizon(p))
    else:
        per_vin = seeds.select("vin", "seed_n", "seed_avg")
        s = pieces.join(per_vin, "vin", "left").fillna({"seed_n": 0, "seed_avg": 0.0})
        s = without_settled(s, p, gap_ms, horizon(p, F.col("seed_avg")))
    w = Window.partitionBy("vin").orderBy(*ORDER)
    # the window first: what is taken out of ``first`` beside it would travel in its shuffle
    s = s.withColumn("before", F.lag("last").over(w))
    s = s.withColumn("gap", _gap_before(F.col("before"), gap_ms))
    if not entered:
        enters = _first_of_chunk() & F.col("before").isNotNull() & ~F.col("gap")
        s = s.withColumn("prev", F.col("before")).withColumns({c: F.col("first")[c] for c in ("ts", "seq", "lat", "lon")})
        s = measured(s, p, enters)
        acc = F.col("accepted") == 1
        more = lambda name, seg: F.col(name) + F.when(acc, F.col(seg)).otherwise(0.0)
        s = s.withColumns(
            {
                "last_acc": F.coalesce(F.col("last_acc"), F.when(acc, F.col("first"))),
                "m": more("m", "seg_m"),
                "kph": more("kph", "seg_kph"),
                "acc_n": F.col("acc_n") + F.col("accepted"),
                "top": F.greatest(F.col("top"), F.when(acc, F.col("seg_kph"))),
                "v": F.when(acc, F.concat(F.array("seg_kph"), F.col("v"))).otherwise(F.col("v")),
            }
        )
    begins = F.col("gap").cast("long") + F.col("opens")
    s = s.withColumn("trip_no", F.sum(begins).over(w.rowsBetween(chunked.UNB, chunked.CUR)))
    earlier = Window.partitionBy(*TRIP).orderBy(*ORDER).rowsBetween(chunked.UNB, -1)
    s = s.withColumn("n0", F.coalesce(F.sum("acc_n").over(earlier), F.lit(0)))
    s = s.withColumn("kph0", F.coalesce(F.sum("kph").over(earlier), F.lit(0.0)))
    limit = horizon(p, None if seeds is None else F.col("seed_avg"))
    return s.withColumn("fold_block", F.floor(F.col("n0") / F.lit(p.fold_block))).withColumn("limit", limit)


def trip_totals(placed_pieces: DataFrame, p: Params) -> DataFrame:
    """One row per trip: its sums, first and last points, ``speeds`` of its first block and ``maps`` of the later ones."""
    first_block = F.col("fold_block") == 0
    totals = placed_pieces.groupBy(*TRIP).agg(
        F.sum("n").alias("n_rows"),
        F.max("has_bridge").alias("has_bridge"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.max("last_acc").alias("last_acc"),
        F.sum("m").alias("acc_m"),
        F.sum("acc_n").alias("acc_n"),
        F.max("top").alias("acc_max_kph"),
        F.sum("kph").alias("acc_kph"),
        F.flatten(_in_order(first_block, ORDER, "v")).alias("speeds"),
    )
    readings = F.col("seed_n") + F.col("n0")
    later = placed_pieces.where(~first_block & (readings < F.col("limit"))).groupBy(*TRIP, "fold_block").agg(
        F.min(readings).alias("n"),
        F.min(F.col("seed_n") * F.col("seed_avg") + F.col("kph0")).alias("total"),
        F.max(F.greatest(F.lit(float(p.anomaly_speed_kph)), F.col("seed_avg"))).alias("top"),
        F.flatten(_in_order(F.lit(True), ORDER, "v")).alias("v"),
    )
    maps = later.repartition(*TRIP, "fold_block").mapInArrow(block_maps, MAPS_DDL)
    maps = maps.groupBy(*TRIP).agg(F.array_sort(F.collect_list(F.struct("fold_block", "lo", "map"))).alias("maps"))
    return totals.join(maps, list(TRIP), "left")
