"""Deterministic view of the driver's ``events`` table as vehicle fixes.

The driver tables carry no GPS data; every query on them reads ``events`` and
maps each row to one fix of vehicle ``VIN<user_id>``. The mapping is plain
column arithmetic, so scans keep column pruning and filter pushdown.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the adapter (shared with the SQL oracle).
LAT_BASE = 30.266
LON_BASE = -97.730
LAT_MULT = 7919
LON_MULT = 104729
RESEND_EVERY = 50            # every 50th event is sent twice ...
RESEND_LAT_SHIFT = 1.0       # ... with a shifted latitude ...
RESEND_SEQ_OFFSET = 1_000_000_000  # ... arriving after all originals
RUN1_END = "2024-01-16 00:00:00"   # run 1 holds events before this ...
LATE_EVERY = 13              # ... except every 13th, which arrives late in run 2


def _epoch_ms() -> Column:
    # events.ts is timestamp_ntz: the difference to the NTZ epoch is time-zone free
    # and floors sub-millisecond parts (epoch micros div 1000)
    return F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) div 1000")


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _position_columns(ev: DataFrame) -> list[Column]:
    eid = F.col("event_id")
    return [
        F.format_string("VIN%06d", F.col("user_id")).alias("vin"),
        _epoch_ms().alias("timestamp"),
        (F.lit(LAT_BASE) + ((eid * LAT_MULT) % 1000) / F.lit(100.0)).alias("latitude"),
        (F.lit(LON_BASE) + ((eid * LON_MULT) % 1000) / F.lit(100.0)).alias("longitude"),
        F.col("value").cast("double").alias("speed"),
        (F.lit(180.0) + ((eid * 31) % 400) / F.lit(10.0)).alias("engine_temp"),
        (((eid * 17) % 1001) / F.lit(1000.0)).alias("gas_tank_level"),
        F.when(F.col("event_type") == "error", F.lit("P0420")).otherwise(F.lit("")).alias("obd2_error_code"),
        eid.alias("arrival_seq"),
    ]


def events_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored fixes (``car_positions`` shape, all unprocessed)."""
    ev = read_events(spark, sf_dir)
    return ev.select(*_position_columns(ev), F.lit(False).alias("processed"))


def events_positions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fixes as a file stream over the events table (one file, one micro-batch)."""
    schema = read_events(spark, sf_dir).schema
    ev = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return ev.select(*_position_columns(ev), F.lit(False).alias("processed"))


def events_positions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inbound messages (nested location), before ingest normalisation."""
    return _as_messages(events_positions(spark, sf_dir))


def _as_messages(p: DataFrame) -> DataFrame:
    return p.select(
        "vin",
        "timestamp",
        F.struct(F.col("latitude"), F.col("longitude")).alias("location"),
        "speed",
        "engine_temp",
        "gas_tank_level",
        "obd2_error_code",
        "arrival_seq",
    )


def events_positions_with_resends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inbound messages plus a re-sent, altered copy of every 50th event."""
    return _with_resends(events_positions_raw(spark, sf_dir))


def events_raw_stream_with_resends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages and copies as a file stream."""
    return _with_resends(_as_messages(events_positions_stream(spark, sf_dir)))


def _with_resends(raw: DataFrame) -> DataFrame:
    resent = raw.filter(F.col("arrival_seq") % RESEND_EVERY == 0).select(
        "vin",
        "timestamp",
        F.struct(
            (F.col("location.latitude") + F.lit(RESEND_LAT_SHIFT)).alias("latitude"),
            F.col("location.longitude").alias("longitude"),
        ).alias("location"),
        "speed",
        "engine_temp",
        "gas_tank_level",
        "obd2_error_code",
        (F.col("arrival_seq") + F.lit(RESEND_SEQ_OFFSET)).alias("arrival_seq"),
    )
    return raw.unionByName(resent)


def events_run_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(run-1 fixes, all fixes): every 13th early event only arrives for run 2."""
    ev = read_events(spark, sf_dir)
    pos = ev.select(
        *_position_columns(ev),
        F.lit(False).alias("processed"),
        (F.col("ts") < F.lit(RUN1_END).cast("timestamp_ntz")).alias("_early"),
    )
    run1 = pos.filter(F.col("_early") & (F.col("arrival_seq") % LATE_EVERY != 0)).drop("_early")
    return run1, pos.drop("_early")
