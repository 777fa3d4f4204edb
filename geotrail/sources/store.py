"""Parquet tables of the trip analytics, written append by append and run by run.

Layout under one root folder (on a cluster: a shared file system path)::

    positions/append=<n>/event_date=.../    fixes of one append (I4)
    days/append=<n>/                        its fixes counted per vehicle and date
    vehicles/append=<n>/                    vehicles first seen in it
    runs/run=<n>/kind=.../                  all outputs of one run, written in one job:
        current_trips (full snapshot, I5), completed_trips (I6), speed_alerts (I7),
        processed (marks, W2), pending (fixes left unprocessed, read by the next run),
        vehicle_totals (what the run adds to each vehicle's totals)
    log/entry=append|run/number=<n>/        one row: the append or run is complete

All of it is written by Spark's own file committer: an attempt overwrites the folder of its number, and the row in
``log`` is written last. What has no row there is invisible, and the next attempt takes the same
number and replaces it whole. A run's row holds its id, its clock (``as_of_ms``) and the last append it has read: a fix
that lands later, whatever its ``arrival_seq``, belongs to a later append and is read by a later run.
A store has one writer at a time, as the original has one run at a time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotrail.config import POSITIONS_PAGE_SIZE, ensure_checkpoint_dir
from geotrail.schema import CAR_POSITIONS, COMPLETED_TRIPS, CURRENT_TRIPS, SPEED_ALERTS

MARKS = T.StructType([T.StructField("vin", T.StringType()), T.StructField("timestamp", T.LongType()), T.StructField("arrival_seq", T.LongType())])
LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("as_of_ms", T.LongType()),
        T.StructField("appends", T.LongType()),
        T.StructField("vehicles", T.LongType()),
        T.StructField("active_trips", T.LongType()),
        T.StructField("completed_trips", T.LongType()),
        T.StructField("speed_alerts", T.LongType()),
    ]
)
LOG_KEYS = [T.StructField("entry", T.StringType()), T.StructField("number", T.LongType())]
TOTALS = T.StructType(
    [
        T.StructField("vin", T.StringType()),
        T.StructField("completed_trips_count", T.LongType()),
        T.StructField("total_distance_meters", T.DoubleType()),
        # sum of the trips' means in millionths: exact, whatever the order of runs
        T.StructField("mean_micro", T.DecimalType(38, 0)),
        T.StructField("speed_alerts_count", T.LongType()),
    ]
)
VEHICLES = T.StructType([T.StructField("vin", T.StringType())])
DAYS = T.StructType([*VEHICLES.fields, T.StructField("event_date", T.DateType()), T.StructField("n", T.LongType())])


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh folder below the session's shared checkpoint directory."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, "geotrail", uuid.uuid4().hex, *parts])


def persist(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: cuts lineage between runs.

    Survives executor loss (the data is on the shared file system, unlike a
    local checkpoint) and lets the next run start from a short plan.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


@dataclass(frozen=True)
class RunInfo:
    """A run's row in the log."""

    number: int
    run_id: str
    as_of_ms: int | None
    appends: int        # number of appends it and its predecessors have read


@dataclass(frozen=True)
class Snapshot:
    """All tables as of one committed run."""

    positions: DataFrame
    current_trips: DataFrame
    completed_trips: DataFrame
    speed_alerts: DataFrame
    last_computed_at: int | None


class TripStore:
    """Run-by-run trip tables under one root folder.

    Runs are incremental: a run reads the appends committed since the last
    committed run (a partition filter) plus that run's leftover unprocessed fixes, never
    the whole history.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        # an empty table of each, so that all can be read from the start; an existing one is left alone
        for name, keys in (("positions", ["append", "event_date"]), ("days", ["append"]), ("vehicles", ["append"]), ("runs", ["run", "kind"]), ("log", ["entry", "number"])):
            fields = [T.StructField(k, T.StringType()) for k in (*keys, "vin")]
            spark.createDataFrame([], T.StructType(fields)).write.mode("ignore").partitionBy(*keys).parquet(f"{self.root}/{name}")

    # ---- the log

    def _log(self, entry: str) -> DataFrame:
        schema = T.StructType([*LOG.fields, *LOG_KEYS])
        return self.spark.read.schema(schema).parquet(f"{self.root}/log").where(F.col("entry") == entry)

    def _last(self, entry: str) -> int:
        return self._log(entry).agg(F.max("number")).first()[0] or 0

    def _commit(self, entry: str, number: int, **values) -> None:
        row = self.spark.createDataFrame([tuple(values.get(f.name) for f in LOG.fields)], LOG).coalesce(1)
        row.write.mode("overwrite").parquet(f"{self.root}/log/entry={entry}/number={number}")

    def last_run(self) -> RunInfo | None:
        return self._run(None)

    def _run(self, number: int | None) -> RunInfo | None:
        log = self._log("run") if number is None else self._log("run").where(F.col("number") == number)
        rows = log.orderBy(F.col("number").desc()).limit(1).collect()
        return RunInfo(rows[0].number, rows[0].run_id, rows[0].as_of_ms, rows[0].appends) if rows else None

    def run_ids(self) -> set[str]:
        return {r.run_id for r in self._log("run").select("run_id").collect()}

    # ---- outputs of runs

    def _table(self, kind: str, schema, number: int | None = None, only_last: bool = False) -> DataFrame:
        """One output kind of the committed runs up to ``number`` (or of that run alone)."""
        last = self._last("run") if number is None else number
        keys = [T.StructField("run", T.LongType()), T.StructField("kind", T.StringType())]
        df = self.spark.read.schema(T.StructType([*schema.fields, *keys])).parquet(f"{self.root}/runs")
        runs = F.col("run") == last if only_last else F.col("run") <= last
        return df.filter(runs & (F.col("run") > 0) & (F.col("kind") == kind)).drop("run", "kind")

    def processed_marks(self, number: int | None = None) -> DataFrame:
        return self._table("processed", MARKS, number)

    def current_trips(self, number: int | None = None) -> DataFrame:
        return self._table("current_trips", CURRENT_TRIPS, number, only_last=True)

    def completed_trips(self, number: int | None = None) -> DataFrame:
        return self._table("completed_trips", COMPLETED_TRIPS, number)

    def speed_alerts(self, number: int | None = None) -> DataFrame:
        return self._table("speed_alerts", SPEED_ALERTS, number)

    def pending(self, number: int | None = None) -> DataFrame:
        """Fixes the newest committed run left unprocessed (retried by the next run)."""
        return self._table("pending", CAR_POSITIONS, number, only_last=True)

    def snapshot(self, number: int | None = None) -> Snapshot:
        """Every table as of one run (default: the newest), with that run's clock."""
        info = self._run(number)
        if info is None:
            return Snapshot(self.positions(), self.current_trips(0), self.completed_trips(0), self.speed_alerts(0), None)
        n = info.number
        return Snapshot(
            self.positions(n, info.appends), self.current_trips(n), self.completed_trips(n), self.speed_alerts(n), info.as_of_ms
        )

    # ---- fixes

    def _appended(self, name: str, schema, after: int = 0, upto: int | None = None) -> DataFrame:
        last = self._last("append") if upto is None else upto
        schema = T.StructType([*schema.fields, T.StructField("append", T.LongType())])
        df = self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        return df.filter((F.col("append") > after) & (F.col("append") <= last)).drop("append")

    def _fixes(self, after: int = 0, upto: int | None = None) -> DataFrame:
        return self._dated(after, upto).select(*CAR_POSITIONS.fieldNames())

    def _dated(self, after: int = 0, upto: int | None = None) -> DataFrame:
        return self._appended("positions", T.StructType([*CAR_POSITIONS.fields, T.StructField("event_date", T.DateType())]), after, upto)

    def positions(self, number: int | None = None, upto: int | None = None) -> DataFrame:
        """All stored fixes with their processed flags (for reads, not for runs)."""
        from geotrail.plans.run import apply_processed

        return apply_processed(self._fixes(upto=upto), self.processed_marks(number))

    def unprocessed(self) -> DataFrame:
        """What the next run reads: new appends plus the last run's leftovers."""
        last = self.last_run()
        new = self._fixes(after=last.appends if last else 0)
        return new.unionByName(self.pending()).withColumn("processed", F.lit(False))

    def append_positions(self, messages: DataFrame) -> DataFrame:
        """Store the first arrival of every new key; returns the outcome of every message.

        Raw messages are normalised first. Messages without an ``arrival_seq`` are numbered here, after
        all that is stored.
        """
        from geotrail.sources.ingest import append_positions, dedupe, judged, normalize, outcome_columns

        number = self._last("append") + 1
        numbered = "arrival_seq" in messages.columns
        batch = normalize(messages) if "location" in messages.columns else messages
        if not numbered:
            batch = batch.withColumn("arrival_seq", F.lit(number << 40) + F.monotonically_increasing_id())
        columns = batch.columns
        # read several times below: fixed numbers, and one normalisation
        batch = persist(batch.withColumn("_row", F.monotonically_increasing_id()), scratch_path(self.spark, "append"))
        stored = self._dated(upto=number - 1) if number > 1 else None
        path = f"{self.root}/positions/append={number}"
        # what is stored and what is answered both follow from the verdict on each message
        marked = persist(judged(batch, stored), scratch_path(self.spark, "judged"))
        keyless = dedupe(batch.where(F.col("vin").isNull() | F.col("timestamp").isNull()).select(*columns))
        append_positions(marked.where("is_new").select(*columns).unionByName(keyless), path, mode="overwrite")
        outcomes = outcome_columns(marked, F.col("success"))
        written = self._dated(after=number - 1, upto=number)
        days = written.groupBy("vin", "event_date").agg(F.count(F.lit(1)).alias("n"))
        days.write.mode("overwrite").parquet(f"{self.root}/days/append={number}")
        mine = self._appended("days", DAYS, after=number - 1, upto=number).select("vin").distinct()
        new = mine.join(self._appended("vehicles", VEHICLES, upto=number - 1), "vin", "left_anti")
        new.write.mode("overwrite").parquet(f"{self.root}/vehicles/append={number}")
        self._commit("append", number, vehicles=self._appended("vehicles", VEHICLES, after=number - 1, upto=number).count())
        return outcomes

    # ---- committing runs

    def commit(self, result, run_id: str, todo: DataFrame | None = None, as_of_ms: int | None = None, appends: int | None = None) -> int:
        """Write all outputs of one run, partitioned by kind, then its row in the log.

        What follows from the outputs (the fixes of ``todo`` that stay unprocessed, the vehicles' totals) is
        computed from the written ones.
        """
        from geotrail.plans.run import MARK_KEY, multiplexed

        if run_id in self.run_ids():
            raise ValueError(f"run {run_id!r} is already committed")
        number = self._last("run") + 1
        path = f"{self.root}/runs/run={number}"
        # an attempt that failed half way may have left kinds that this one doesn't have: the whole folder is replaced
        multiplexed(result).write.mode("overwrite").partitionBy("kind").parquet(path)
        written = {kind: self._table(kind, schema, number, only_last=True) for kind, schema in
                   (("processed", MARKS), ("completed_trips", COMPLETED_TRIPS), ("speed_alerts", SPEED_ALERTS))}
        more = vehicle_totals(written["completed_trips"], written["speed_alerts"]).withColumn("kind", F.lit("vehicle_totals"))
        if todo is not None:
            left = todo.join(written["processed"], MARK_KEY, "left_anti").withColumn("kind", F.lit("pending"))
            more = more.unionByName(left, allowMissingColumns=True)
        more.write.mode("append").partitionBy("kind").parquet(path)
        upto = self._last("append") if appends is None else appends
        self._commit("run", number, run_id=run_id, as_of_ms=as_of_ms, appends=upto, **self._counts(number))
        return number

    def _counts(self, number: int) -> dict[str, int]:
        """Rows the run wrote per kind (from Parquet footers)."""
        keys = T.StructType([T.StructField("run", T.LongType()), T.StructField("kind", T.StringType())])
        written = self.spark.read.schema(keys).parquet(f"{self.root}/runs").where(F.col("run") == number)
        found = {r.kind: r["count"] for r in written.groupBy("kind").count().collect()}
        return {n: found.get(k, 0) for n, k in (("active_trips", "current_trips"), ("completed_trips", "completed_trips"), ("speed_alerts", "speed_alerts"))}

    def run(self, as_of_ms: int, params=None, run_id: str | None = None) -> str:
        """Run the analytics once over the new and leftover fixes and commit the result."""
        from geotrail.config import DEFAULT
        from geotrail.plans.run import run_batch

        appends = self._last("append")
        rid = run_id or f"{self._last('run') + 1:06d}-{as_of_ms:016d}"
        todo = self.unprocessed()
        result = run_batch(todo, self.current_trips(), as_of_ms, params or DEFAULT)
        self.commit(result, rid, todo, as_of_ms, appends)
        return rid

    # ---- reads that don't touch the fixes, or few of them

    def vehicles(self) -> DataFrame:
        """A1 from the vehicles each append brought."""
        return self._appended("vehicles", VEHICLES)

    def fleet_summary(self) -> DataFrame:
        """J3 from the log alone: each append and run has counted what it wrote."""
        seen = self._log("append").agg(F.coalesce(F.sum("vehicles"), F.lit(0)).alias("total_vehicles"))
        runs = self._log("run").agg(
            F.coalesce(F.max_by("active_trips", "number"), F.lit(0)).alias("active_trips"),
            F.coalesce(F.sum("completed_trips"), F.lit(0)).alias("completed_trips"),
            F.coalesce(F.sum("speed_alerts"), F.lit(0)).alias("total_speed_alerts"),
            F.max_by("as_of_ms", "number").alias("last_computed_at"),
        )
        names = ["total_vehicles", "active_trips", "completed_trips", "total_speed_alerts", "last_computed_at"]
        return seen.unionByName(runs, allowMissingColumns=True).agg(*[F.max(n).cast("long").alias(n) for n in names])

    def vehicle_totals(self) -> DataFrame:
        """A4 + A5 per vehicle: the runs' own totals, added up."""
        return (
            self._table("vehicle_totals", TOTALS)
            .groupBy("vin")
            .agg(*[F.sum(n).alias(n) for n in TOTALS.fieldNames() if n != "vin"])
            .select(
                "vin",
                "completed_trips_count",
                F.when(F.col("completed_trips_count") > 0, F.col("total_distance_meters")).alias("total_distance_meters"),
                F.when(
                    F.col("completed_trips_count") > 0, F.col("mean_micro").cast("double") / (F.col("completed_trips_count") * F.lit(1e6))
                ).alias("average_speed_kph"),
                "speed_alerts_count",
            )
        )

    def vehicle_summary(self, vins=None) -> DataFrame:
        """J2 from vehicles, open trips and the runs' totals: no fix, trip or alert of an earlier run is read."""
        from geotrail.plans.views import summary_of_vehicles

        last = self.last_run()
        return summary_of_vehicles(self.vehicles(), self.current_trips(), self.vehicle_totals(), last.as_of_ms if last else None, vins)

    def recent_positions(self, n: int = POSITIONS_PAGE_SIZE, vins=None) -> DataFrame:
        """T1 from the newest dates only.

        The per-day counts tell, per vehicle, the dates that hold its latest ``n`` fixes; of the fixes only
        partitions of these dates are read (pruned while the query runs), and of them only those vehicles.
        """
        from geotrail.plans.views import recent_positions

        return recent_positions(self.newest_fixes(n, vins), n, vins)

    def newest_fixes(self, n: int, vins=None) -> DataFrame:
        """The stored fixes on the dates that hold each vehicle's latest ``n``."""
        from geotrail.plans.views import newest_dates

        days = self._appended("days", DAYS)
        days = days if vins is None else days.where(F.col("vin").isin(list(vins)))
        wanted = newest_dates(days, n)
        fixes = self._dated()
        dates = F.broadcast(wanted.select("event_date").distinct())  # one row per calendar day
        return fixes.join(dates, "event_date", "left_semi").join(wanted, ["vin", "event_date"], "left_semi").drop("event_date")


def vehicle_totals(completed: DataFrame, alerts: DataFrame) -> DataFrame:
    """What a run adds to each vehicle's totals (``TOTALS``); sums of them are totals again."""
    micro = F.round(F.col("average_speed_kph") * 1e6).cast("decimal(28,0)")
    none = F.lit(0).cast("long")
    trips = completed.select("vin", F.lit(1).cast("long").alias("t"), F.col("total_distance_meters").alias("m"), micro.alias("v"), none.alias("a"))
    fast = alerts.select("vin", none.alias("t"), F.lit(0.0).alias("m"), F.lit(0).cast("decimal(28,0)").alias("v"), F.lit(1).cast("long").alias("a"))
    return trips.unionByName(fast).groupBy("vin").agg(
        F.sum("t").alias("completed_trips_count"), F.sum("m").alias("total_distance_meters"),
        F.sum("v").cast("decimal(38,0)").alias("mean_micro"), F.sum("a").alias("speed_alerts_count"),
    )
