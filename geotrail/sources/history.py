"""The whole history split into trips (S6), kept up to date append by append.

A trip of the history ends where no fix of its vehicle follows within the timeout, so new fixes can only change the
trips they come near: an append extends or joins the *spans* (first fix to last fix) that lie within the timeout of one of
its fixes, and leaves all others as they are. The spans are merged as intervals per vehicle; fixes are read again only inside
those that changed, from the dates they cover.

Next to a :class:`geotrail.sources.store.TripStore`'s tables::

    history/append=<n>/    trips (lone fixes too) computed when append n came in
    replaced/append=<n>/   spans that those took the place of
    log/entry=history/     appends taken in
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from geotrail.config import DEFAULT, Params
from geotrail.functions.geo import duration_minutes
from geotrail.operators import chunked, trips
from geotrail.operators.segments import fix_rows
from geotrail.sources.store import TripStore, persist, scratch_path

SPAN = T.StructType([T.StructField("vin", T.StringType()), T.StructField("first_ts", T.LongType()), T.StructField("last_ts", T.LongType())])
APPEND = T.StructField("append", T.LongType())
HISTORY = T.StructType(
    [
        *SPAN.fields,
        T.StructField("n_rows", T.LongType()),
        T.StructField("trip_start_timestamp", T.LongType()),
        T.StructField("last_update_timestamp", T.LongType()),
        *[T.StructField(c, T.DoubleType()) for c in ("start_lat", "start_lon", "last_lat", "last_lon")],
        *[T.StructField(c, T.DoubleType()) for c in ("total_distance_meters", "average_speed_kph", "max_speed_kph")],
        T.StructField("total_readings", T.IntegerType()),
    ]
)
DAY_MS = 86_400_000


def merged_spans(old: DataFrame, new: DataFrame, gap_ms: int) -> tuple[DataFrame, DataFrame]:
    """(spans of ``old`` that a new span reaches, ``vin, lo, hi`` of what they merge to).

    Spans whose ends lie at most ``gap_ms`` apart belong together, directly or through others.
    """
    both = old.withColumn("is_new", F.lit(False)).unionByName(new.withColumn("is_new", F.lit(True)), allowMissingColumns=True)
    w = Window.partitionBy("vin").orderBy("first_ts", "last_ts")
    reach = F.max("last_ts").over(w.rowsBetween(Window.unboundedPreceding, -1))
    both = both.withColumn("reach", reach)
    opens = F.when(F.col("first_ts") - F.col("reach") <= F.lit(gap_ms), 0).otherwise(1)
    both = both.withColumn("opens", opens).withColumn("group", F.sum("opens").over(w))
    touched = both.withColumn("touched", F.max("is_new").over(Window.partitionBy("vin", "group"))).where("touched")
    ranges = touched.groupBy("vin", "group").agg(F.min("first_ts").alias("lo"), F.max("last_ts").alias("hi"))
    return touched.where(~F.col("is_new")).select(*old.columns), ranges.drop("group")


class TripHistory:
    """The trips of a store's whole history."""

    def __init__(self, store: TripStore, p: Params = DEFAULT):
        self.store, self.p, self.spark = store, p, store.spark
        for name, schema in (("history", HISTORY), ("replaced", SPAN)):
            empty = self.spark.createDataFrame([], T.StructType([*schema.fields, APPEND]))
            empty.write.mode("ignore").partitionBy("append").parquet(f"{store.root}/{name}")

    def _table(self, name: str, schema: T.StructType, upto: int) -> DataFrame:
        df = self.spark.read.schema(T.StructType([*schema.fields, APPEND])).parquet(f"{self.store.root}/{name}")
        return df.where((F.col("append") > 0) & (F.col("append") <= upto))

    def _rows(self, upto: int) -> DataFrame:
        """Trips that no later append has replaced."""
        gone = self._table("replaced", SPAN, upto).select("vin", "first_ts", F.col("append").alias("by"))
        gone = gone.groupBy("vin", "first_ts").agg(F.max("by").alias("by"))
        rows = self._table("history", HISTORY, upto).join(gone, ["vin", "first_ts"], "left")
        return rows.where(F.col("by").isNull() | (F.col("by") <= F.col("append"))).drop("by")

    def extend(self) -> int:
        """Take in the appends that came since; returns the number of the last one."""
        store, gap = self.store, self.p.trip_timeout_ms
        done, last = store._last("history"), store._last("append")
        if last == done:
            return done
        new = store._fixes(after=done, upto=last)
        old = self._rows(done).select(*SPAN.fieldNames()).join(new.select("vin").distinct(), "vin", "left_semi")
        touched, ranges = merged_spans(old, self._spans(new), gap)
        # as many rows as the append has trips; the fixes' scan is pruned by them
        ranges = persist(ranges, scratch_path(self.spark, "ranges"))
        again = self._fixes_in(ranges, done)
        totals = trips.trip_totals(again.unionByName(new), self.p, gap)
        found = trips.trip_columns(totals, keep=("first", "last")).select(
            "vin", F.col("first.ts").alias("first_ts"), F.col("last.ts").alias("last_ts"), *HISTORY.fieldNames()[3:]
        )
        # trips first: they are told from stored ones by the append, and count once the log says so
        found.write.mode("overwrite").parquet(f"{store.root}/history/append={last}")
        touched.write.mode("overwrite").parquet(f"{store.root}/replaced/append={last}")
        store._commit("history", last)
        return last

    def _spans(self, positions: DataFrame) -> DataFrame:
        """Spans of fixes that follow each other within the timeout, cut at chunk borders (:func:`merged_spans` joins them).

        Only times are read and shuffled; no segment is measured.
        """
        rows = chunked.keyed(chunked.add_chunk(fix_rows(positions), self.p)).select("vin", "chunk", "ts")
        w = Window.partitionBy("vin", "chunk").orderBy("ts")
        opens = (F.col("ts") - F.lag("ts").over(w) > F.lit(self.p.trip_timeout_ms)).cast("int")
        parts = rows.withColumn("opens", opens).withColumn("part", F.coalesce(F.sum("opens").over(w), F.lit(0)))
        spans = parts.groupBy("vin", "chunk", "part").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
        return spans.select(*SPAN.fieldNames())

    def _fixes_in(self, ranges: DataFrame, upto: int) -> DataFrame:
        """Stored fixes inside the ranges, found by vehicle and date."""
        day = lambda ms: F.floor(ms / DAY_MS).cast("int")
        dates = F.explode(F.transform(F.sequence(day(F.col("lo")), day(F.col("hi"))), F.date_from_unix_date))
        by_date = ranges.select("vin", "lo", "hi", dates.alias("event_date"))
        near = self.store._dated(upto=upto).join(by_date, ["vin", "event_date"]).where(F.col("timestamp").between(F.col("lo"), F.col("hi")))
        return near.select(*self.store._fixes(upto=0).columns)

    def read(self, as_of_ms: int) -> DataFrame:
        """The trips, as :func:`geotrail.operators.trips.trip_segmentation` of all fixes gives them."""
        rows = self._rows(self.store._last("history"))
        w = Window.partitionBy("vin").orderBy("first_ts")
        t = rows.withColumns({"no": F.row_number().over(w) - 1, "newest": F.max("first_ts").over(Window.partitionBy("vin"))})
        is_open = (F.col("first_ts") == F.col("newest")) & (F.lit(as_of_ms) - F.col("last_update_timestamp") <= F.lit(self.p.trip_timeout_ms))
        return t.where(F.col("n_rows") >= 2).select(
            "vin", F.col("no").cast("long").alias("trip_no"), "trip_start_timestamp", F.col("last_update_timestamp").alias("trip_end_timestamp"),
            "start_lat", "start_lon", F.col("last_lat").alias("end_lat"), F.col("last_lon").alias("end_lon"),
            "total_distance_meters", "average_speed_kph", "max_speed_kph", "total_readings",
            duration_minutes("trip_start_timestamp", "last_update_timestamp").alias("duration_minutes"), is_open.alias("is_open"),
        )
