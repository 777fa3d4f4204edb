"""Ordered per-vehicle scans that never put one vehicle into one task.

A plain ``Window.partitionBy("vin")`` sorts all rows of a vehicle in one task;
one vehicle holding a third of the data would then be a third of the job on
one core. Instead every row gets a time ``chunk`` (``ts`` floored to
``chunk_ms``) and all row-level windows are partitioned by ``(vin, chunk)``.
What a row needs from outside its chunk -- the previous and next fix, the state of its vehicle -- is computed
on a per-chunk summary (one row per non-empty ``(vin, chunk)``, so a vehicle contributes at most
``time span / chunk_ms`` summary rows whatever its row count) and reaches the rows as one more row of
their chunk (:func:`with_halo`). The rows are shuffled once, on ``(vin, chunk)``, and never joined.
Ordered counts over a vehicle (trip numbers, ranks) are left to :mod:`geotrail.operators.pieces`.

Row contract: columns ``vin, ts, seq, lat, lon`` (``seq`` breaks timestamp
ties, e.g. arrival order) plus anything else, which is carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from geotrail.config import Params

KEY = "vin"
ORDER = ("ts", "seq")
UNB = Window.unboundedPreceding
CUR = Window.currentRow
CHUNK_ROWS = 1_000_000       # fixes that one chunk of a dense vehicle should hold
DENSE_VEHICLES = 1024        # entries of Params.dense at most


def point() -> Column:
    """A fix as a struct ordered by time first, so min/max give first/last."""
    return F.struct(F.col("ts"), F.col("seq"), F.col("lat"), F.col("lon"))


def width(p: Params) -> Column:
    """Chunk width (ms) of the row's vehicle."""
    base = F.lit(int(p.chunk_ms)).cast("long")
    if not p.dense:
        return base
    narrow = F.create_map(*[c for vin, ms in p.dense for c in (F.lit(vin), F.lit(int(ms)).cast("long"))])
    return F.coalesce(F.try_element_at(narrow, F.col(KEY)), base)


def add_chunk(rows: DataFrame, p: Params) -> DataFrame:
    """Add ``chunk``: the start (epoch ms) of the row's time chunk.

    Fixes are unique per vehicle and millisecond once deduplicated, so the
    width alone bounds the rows of a vehicle-chunk.
    """
    if "chunk" in rows.columns:
        return rows
    return rows.withColumn("chunk", (F.col("ts") - F.pmod(F.col("ts"), width(p))).cast("long"))


def for_dense(positions: DataFrame, p: Params, rows: int = CHUNK_ROWS) -> Params:
    """``p`` with narrower chunks for dense vehicles, so that no chunk holds many more than ``rows`` fixes.

    One counting pass over ``vin, timestamp`` that combines map-side. The list that reaches the driver and the plan holds
    at most ``DENSE_VEHICLES`` entries, the vehicles with the most fixes; any other vehicle has less than
    one in so many of all fixes.
    """
    per_vin = positions.where(F.col(KEY).isNotNull() & F.col("timestamp").isNotNull()).groupBy(KEY).agg(
        F.count(F.lit(1)).alias("n"), (F.max("timestamp") - F.min("timestamp") + 1).alias("span")
    )
    # fixes per chunk if they were spread evenly over the time they cover
    per_chunk = F.col("n") * F.least(F.lit(float(p.chunk_ms)) / F.col("span"), F.lit(1.0))
    narrow = F.greatest(F.floor(F.least(F.lit(p.chunk_ms), F.col("span")) * rows / per_chunk), F.lit(1))
    top = per_vin.where(per_chunk > rows).orderBy(F.col("n").desc(), KEY).limit(DENSE_VEHICLES)
    return p.with_(dense=tuple((r.vin, r.width) for r in top.select(KEY, narrow.cast("long").alias("width")).collect()))


def keyed(rows: DataFrame) -> DataFrame:
    """Rows that belong to a vehicle and a chunk."""
    return rows.filter(F.col(KEY).isNotNull() & F.col("chunk").isNotNull())


def with_previous(rows: DataFrame) -> DataFrame:
    """Add ``prev``: the fix before each row in its chunk (null for a chunk's first)."""
    return keyed(rows).withColumn("prev", F.lag(point()).over(Window.partitionBy(KEY, "chunk").orderBy(*ORDER)))


def entering(summary: DataFrame) -> DataFrame:
    """Each chunk's first fix as ``ts, seq, lat, lon`` with ``prev``, the vehicle's last fix before the chunk.

    ``summary`` has ``vin, chunk, first, last`` (and more, kept), one row per chunk.
    """
    before = F.lag("last").over(Window.partitionBy(KEY).orderBy("chunk"))
    # the window first: what is taken out of ``first`` beside it would travel in its shuffle
    s = summary.withColumn("prev", before)
    return s.select("*", *[F.col("first")[c].alias(c) for c in ("ts", "seq", "lat", "lon")])


def pairs(rows: DataFrame) -> DataFrame:
    """One row ``vin, ts, seq, lat, lon, prev`` per pair of consecutive fixes of a vehicle.

    Pairs inside a chunk come from the shuffled rows; the one that enters a chunk
    comes from the chunk summary, which combines map-side. The rows never meet the
    summary, so they are shuffled and sorted once.
    """
    cols = [KEY, "ts", "seq", "lat", "lon", "prev"]
    inside = with_previous(rows).select(*cols)
    ends = keyed(rows).groupBy(KEY, "chunk").agg(F.min(point()).alias("first"), F.max(point()).alias("last"))
    return inside.unionByName(entering(ends).select(*cols)).filter(F.col("prev").isNotNull())


def with_halo(rows: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Each row with its neighbours across chunk borders, after one shuffle of the rows and no join of them.

    The ends of every chunk are found before the shuffle (minimum and maximum combine map-side); a window over
    these per-chunk rows turns them into a *halo* row for each chunk: the vehicle's last fix before it, the first
    after it, and what the run knows of the vehicle. Halo rows enter the shuffle of the rows and sort first in
    their chunk, so a row reads its neighbours by ``lag`` / ``lead`` and, at the chunk's ends, from the halo.

    Adds ``prev`` / ``next`` (struct ts, seq, lat, lon; null at the vehicle's ends), ``is_late``
    (the fix lies at or before its vehicle's bridge row), ``gated_in`` (at least two rows of the vehicle are not late)
    and the columns of ``state`` (one row per vehicle), which joins the per-chunk rows only.
    A bridge row has no ``prev``; late rows' neighbours have no meaning.
    """
    rows = keyed(rows)
    names = [c for c in (state.columns if state is not None else []) if c != KEY]
    ends = rows.groupBy(KEY, "chunk").agg(
        F.min(point()).alias("first"),
        F.max(point()).alias("last"),
        F.count(F.lit(1)).alias("n"),
        F.max(F.when(F.col("is_bridge"), F.col("ts"))).alias("bridge"),
    )
    by_time, whole = Window.partitionBy(KEY).orderBy("chunk"), Window.partitionBy(KEY)
    ends = ends.select(
        KEY,
        "chunk",
        F.lag("last").over(by_time).alias("before"),
        F.lead("first").over(by_time).alias("after"),
        F.max("bridge").over(whole).alias("bridge"),
        F.max(F.col("last")["ts"]).over(whole).alias("newest"),
        F.sum("n").over(whole).alias("n_rows"),
    )
    # beside a bridge one later fix is enough
    gate = F.when(F.col("bridge").isNotNull(), F.col("newest") > F.col("bridge")).otherwise(F.col("n_rows") >= 2)
    if state is not None:
        ends = ends.join(state, KEY, "left")
    halo = ends.select(KEY, "chunk", F.struct("before", "after", "bridge", gate.alias("gated_in"), *names).alias("halo"))
    sent = rows.unionByName(halo, allowMissingColumns=True)
    w = Window.partitionBy(KEY, "chunk").orderBy(F.col("halo").isNull(), *ORDER)
    at = F.when(F.col("halo").isNull(), point())
    d = sent.withColumns({"h": F.first("halo").over(w.rowsBetween(UNB, CUR)), "lag": F.lag(at).over(w), "lead": F.lead(at).over(w)})
    h = F.col("h")
    return d.where(F.col("halo").isNull()).select(
        *rows.columns,
        F.when(~F.col("is_bridge"), F.coalesce(F.col("lag"), h["before"])).alias("prev"),
        F.coalesce(F.col("lead"), h["after"]).alias("next"),
        (~F.col("is_bridge") & F.coalesce(F.col("ts") <= h["bridge"], F.lit(False))).alias("is_late"),
        h["gated_in"].alias("gated_in"),
        *[h[c].alias(c) for c in names],
    )
