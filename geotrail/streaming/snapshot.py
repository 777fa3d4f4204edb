"""Open trips of a stream, kept up to date batch by batch.

Vehicles are dealt into hash buckets. A micro-batch rewrites the buckets it touches, as new files of its own, and one small
row per bucket that says which batch wrote it last::

    <root>_open/buckets/batch_id=<n>/bucket=<b>/     open trips of the bucket after batch n
    <root>_open/versions/batch_id=<n>/               bucket -> the batch that holds it, for all buckets

A reader takes the newest version table and of each bucket that one batch, so what it reads depends on the open
trips, not on how many batches there were. Nothing is changed in place: a replayed batch starts
from the version before it and replaces its own folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotrail.schema import CURRENT_TRIPS

N_BUCKETS = 64
VERSIONS = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("version", T.LongType()), T.StructField("origin", T.StringType())])
BATCH = T.StructField("batch_id", T.LongType())
BUCKET = T.StructField("bucket", T.LongType())


class OpenTrips:
    """The open-trip table beside a stream's output root."""

    def __init__(self, spark: SparkSession, root: str, n_buckets: int = N_BUCKETS):
        self.spark, self.n_buckets = spark, n_buckets
        self.path = f"{root.rstrip('/')}_open"
        for name, schema, keys in (("versions", VERSIONS, ["batch_id"]), ("buckets", CURRENT_TRIPS, ["batch_id", "bucket"])):
            known = set(schema.fieldNames())
            fields = [*schema.fields, *[f for f in (BATCH, BUCKET) if f.name in keys and f.name not in known]]
            spark.createDataFrame([], T.StructType(fields)).write.mode("ignore").partitionBy(*keys).parquet(f"{self.path}/{name}")

    def _versions(self, before: int | None = None) -> DataFrame:
        """The newest version table (of batches before ``before``)."""
        df = self.spark.read.schema(T.StructType([*VERSIONS.fields, BATCH])).parquet(f"{self.path}/versions")
        df = df if before is None else df.where(F.col("batch_id") < before)
        last = df.agg(F.max("batch_id")).first()[0]
        return df.where(F.col("batch_id") == (-1 if last is None else last)).select(*VERSIONS.fieldNames())

    def origin(self) -> str | None:
        """The checkpoint whose batches are stored."""
        row = self._versions().select("origin").first()
        return row.origin if row else None

    def _rows(self, versions: DataFrame) -> DataFrame:
        df = self.spark.read.schema(T.StructType([*CURRENT_TRIPS.fields, BATCH, BUCKET])).parquet(f"{self.path}/buckets")
        # at most n_buckets rows: the batches are pruned before files are opened
        wanted = F.broadcast(versions.select(F.col("version").alias("batch_id"), "bucket"))
        return df.join(wanted, ["batch_id", "bucket"], "left_semi").drop("batch_id")

    def read(self) -> DataFrame:
        """The open trips after the newest batch."""
        return self._rows(self._versions()).select(*CURRENT_TRIPS.fieldNames())

    def merge(self, outputs: DataFrame, batch_id: int, origin: str) -> None:
        """Take in one batch's ``trip`` and ``completed`` rows (at most one vehicle state each)."""
        names = [c for c in CURRENT_TRIPS.fieldNames() if c != "vin"]
        events = outputs.where(F.col("kind").isin("trip", "completed"))
        last = F.max_by(F.struct("kind", *names), F.struct((F.col("kind") == "completed").alias("done"), "last_update_timestamp"))
        changed = events.groupBy("vin").agg(last.alias("l")).withColumn("bucket", F.pmod(F.xxhash64("vin"), F.lit(self.n_buckets)))
        before = self._versions(batch_id)
        touched = changed.select("bucket").distinct()
        kept = self._rows(before.join(F.broadcast(touched), "bucket", "left_semi")).join(changed.select("vin"), "vin", "left_anti")
        new = changed.where(F.col("l.kind") == "trip").select("vin", *[F.col(f"l.{c}").alias(c) for c in names], "bucket")
        rows = kept.unionByName(new).repartition("bucket").sortWithinPartitions("bucket", "vin")
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/buckets/batch_id={batch_id}")
        # the last thing written: a batch without a version table has not happened
        same = before.join(F.broadcast(touched), "bucket", "left_anti").where(F.col("bucket") >= 0).select("bucket", "version")
        versions = same.unionByName(touched.withColumn("version", F.lit(batch_id).cast("long"))).withColumn("origin", F.lit(origin))
        marker = self.spark.createDataFrame([(-1, batch_id, origin)], VERSIONS)  # a batch without trips has a table too
        versions.unionByName(marker).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/versions/batch_id={batch_id}")
