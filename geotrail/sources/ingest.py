"""Ingest of inbound fixes: normalise (I1), first-arrival dedupe (I2), outcomes (I3), store (I4).

Works on batch and streaming DataFrames alike where the operation allows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotrail.config import DUPLICATE_MESSAGE, SAVED_MESSAGE

KEY = ["vin", "timestamp"]
POSITION_COLUMNS = [
    "vin",
    "timestamp",
    "latitude",
    "longitude",
    "speed",
    "engine_temp",
    "gas_tank_level",
    "obd2_error_code",
    "processed",
    "arrival_seq",
]


def normalize(raw: DataFrame) -> DataFrame:
    """Flatten ``location``, apply wire defaults for absent fields, mark unprocessed.

    Absent scalars of the wire format decode as 0 / 0.0 / "" and are stored
    as such, so nulls are replaced by those defaults here. Without an
    ``arrival_seq`` column rows are numbered in scan order (a stream's rows get
    theirs when the store appends them).
    """
    if "arrival_seq" in raw.columns:
        seq = F.coalesce(F.col("arrival_seq").cast("long"), F.lit(0).cast("long"))
    else:
        seq = F.lit(0).cast("long") if raw.isStreaming else F.monotonically_increasing_id()
    return raw.select(
        F.coalesce(F.col("vin"), F.lit("")).alias("vin"),
        F.coalesce(F.col("timestamp").cast("long"), F.lit(0).cast("long")).alias("timestamp"),
        F.coalesce(F.col("location.latitude"), F.lit(0.0)).alias("latitude"),
        F.coalesce(F.col("location.longitude"), F.lit(0.0)).alias("longitude"),
        F.coalesce(F.col("speed"), F.lit(0.0)).alias("speed"),
        F.coalesce(F.col("engine_temp"), F.lit(0.0)).alias("engine_temp"),
        F.coalesce(F.col("gas_tank_level"), F.lit(0.0)).alias("gas_tank_level"),
        F.coalesce(F.col("obd2_error_code"), F.lit("")).alias("obd2_error_code"),
        F.lit(False).alias("processed"),
        seq.alias("arrival_seq"),
    )


def dedupe(positions: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Keep the first arrival per ``(vin, timestamp)``; later copies are ignored.

    A keyed aggregate (``min_by`` on arrival order) rather than a window: it
    combines map-side, and the key includes the timestamp, so one busy vehicle
    still spreads over all reducers. Rows whose key is already ``stored`` are
    dropped too (anti join on the full key).
    """
    cols = [c for c in positions.columns if c not in KEY]
    first = (
        positions.groupBy(*KEY)
        .agg(F.min_by(F.struct(*cols), F.col("arrival_seq")).alias("_r"))
        .select(*KEY, *[F.col("_r")[c].alias(c) for c in cols])
    )
    if stored is not None:
        if "event_date" in stored.columns:
            # only the stored date partitions the batch touches are read (dynamic pruning)
            first = with_event_date(first)
            dates = first.select("event_date").distinct()
            old = stored.join(dates, "event_date", "left_semi").select(*KEY, "event_date")
            first = first.join(old, [*KEY, "event_date"], "left_anti")
        else:
            first = first.join(stored.select(*KEY), KEY, "left_anti")
    return first.select(*positions.columns)


def ingest_outcomes(positions: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Per inbound row: saved (first arrival of a new key) or duplicate ignored.

    Raw messages are normalised first, so a message with an absent key field has its
    outcome too: every input row has exactly one.

    The first arrival per key is a map-side-combined aggregate joined back on
    the key: a key re-sent millions of times is reduced per task before the
    shuffle, and its rows in the join are split by AQE's skew handling (the
    other side has one row per key), never buffered as one window group.
    """
    if "location" in positions.columns:
        positions = normalize(positions)
    first = positions.groupBy(*KEY).agg(F.min("arrival_seq").alias("_first_seq"))
    marked = positions.select(*KEY, "arrival_seq").join(first, KEY, "inner").select(
        *KEY, "arrival_seq", (F.col("arrival_seq") == F.col("_first_seq")).alias("_first")
    )
    if stored is not None:
        if "event_date" in stored.columns:
            # read only the stored date partitions this batch touches (dynamic pruning)
            marked = with_event_date(marked)
            dates = marked.select("event_date").distinct()
            known = stored.join(dates, "event_date", "left_semi").select(*KEY, "event_date").distinct()
            marked = marked.join(known.withColumn("_known", F.lit(True)), [*KEY, "event_date"], "left")
        else:
            known = stored.select(*KEY).distinct().withColumn("_known", F.lit(True))
            marked = marked.join(known, KEY, "left")
        ok = F.col("_first") & F.col("_known").isNull()
    else:
        ok = F.col("_first")
    return outcome_columns(marked, ok)


def judged(batch: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Rows of a numbered batch (``_row``, unique) with ``success`` and ``is_new``, from one join.

    ``success`` is the outcome of :func:`ingest_outcomes`; ``is_new`` holds for the one row per key that
    :func:`dedupe` keeps (several arrivals may share a number). What the join needs of a key are two numbers, found by a
    hash aggregate that combines map-side; whole rows meet it once. Rows without a key are left out.
    """
    first = batch.groupBy(*KEY).agg(
        F.min("arrival_seq").alias("_first_seq"),
        F.coalesce(F.min_by("_row", "arrival_seq"), F.min("_row")).alias("_first_row"),
    )
    known = F.lit(False)
    if stored is not None:
        # of the stored fixes only the keys on dates that the batch touches (dynamic pruning); they meet keys, not rows
        dates = with_event_date(batch.select("timestamp")).select("event_date").distinct()
        old = stored.join(dates, "event_date", "left_semi").select(*KEY).distinct()
        first = first.join(old.withColumn("_known", F.lit(True)), KEY, "left")
        known = F.col("_known").isNotNull()
    return batch.join(first, KEY).select(
        *batch.columns,
        ((F.col("arrival_seq") == F.col("_first_seq")) & ~known).alias("success"),
        ((F.col("_row") == F.col("_first_row")) & ~known).alias("is_new"),
    )


def outcome_columns(marked: DataFrame, success: Column) -> DataFrame:
    message = F.when(success, F.lit(SAVED_MESSAGE)).otherwise(F.lit(DUPLICATE_MESSAGE))
    return marked.select(*KEY, "arrival_seq", success.alias("success"), message.alias("message"))


def with_event_date(positions: DataFrame) -> DataFrame:
    return positions.withColumn("event_date", F.to_date(F.timestamp_millis(F.col("timestamp"))))


def append_positions(new_positions: DataFrame, path: str, mode: str = "append") -> None:
    """Append deduped fixes, partitioned by event date and sorted for min/max skipping.

    Range partitioning on (date, vin, timestamp) samples the keys, so one busy
    vehicle-day is split over several files instead of one task, and every
    file holds a narrow (vin, timestamp) range that Parquet statistics can skip.
    """
    (
        with_event_date(new_positions)
        .repartitionByRange("event_date", "vin", "timestamp")
        .sortWithinPartitions("event_date", "vin", "timestamp")
        .write.mode(mode)
        .partitionBy("event_date")
        .parquet(path)
    )
