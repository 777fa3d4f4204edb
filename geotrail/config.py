"""Parameters and session helpers."""

from __future__ import annotations

import math
import os
import re
import tempfile
from dataclasses import dataclass, replace

# These must equal the reference behaviour for identical results.
SPEED_LIMIT_KPH = 120.0          # speed alert above this (strict)
TRIP_TIMEOUT_MS = 300_000        # open trip closes when now - last update > this (strict)
ANOMALY_SPEED_KPH = 300.0        # segment rejected when computed speed > this (strict)
JUMP_DISTANCE_M = 1000.0         # segment rejected when distance > this ...
JUMP_WINDOW_S = 10.0             # ... and elapsed seconds < this
EARTH_RADIUS_M = 6371000.0
POSITIONS_PAGE_SIZE = 100        # default row count of the latest-positions read
RUN_INTERVAL_MS = 600_000        # default analytics cadence
DUPLICATE_MESSAGE = "Duplicate position ignored"
SAVED_MESSAGE = "Saved successfully"
# not a value of the reference: the stream's answer to fixes older than a vehicle's memory
TOO_OLD_MESSAGE = "Position older than the vehicle's memory"

# Default width of the time chunks that split one vehicle's rows over tasks. It should
# hold some thousand fixes: one hour for 1 Hz data, weeks for sparse data (a width
# near the fix interval makes the per-chunk summary as large as the data).
DEFAULT_CHUNK_MS = 3_600_000
SPARSE_CHUNK_MS = 60 * 86_400_000


@dataclass(frozen=True)
class Params:
    """All tunables of the trip analytics; defaults reproduce the reference."""

    speed_limit_kph: float = SPEED_LIMIT_KPH
    trip_timeout_ms: int = TRIP_TIMEOUT_MS
    anomaly_speed_kph: float = ANOMALY_SPEED_KPH
    jump_distance_m: float = JUMP_DISTANCE_M
    jump_window_s: float = JUMP_WINDOW_S
    earth_radius_m: float = EARTH_RADIUS_M
    # rows of one vehicle are processed in time chunks of this width; the
    # cross-chunk context travels through a per-chunk summary (see operators.chunked)
    chunk_ms: int = DEFAULT_CHUNK_MS
    # narrower widths of the few vehicles with very many fixes, as (vin, ms) pairs (see chunked.for_dense)
    dense: tuple[tuple[str, int], ...] = ()
    # accepted speeds that are folded together (see operators.pieces)
    fold_block: int = 1024

    def __post_init__(self) -> None:
        if not math.isfinite(self.anomaly_speed_kph):
            # the running mean's grid of values is bounded by this limit
            raise ValueError("anomaly_speed_kph must be finite")
        if self.fold_block < 1:
            raise ValueError("fold_block must be at least 1")

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)

    @property
    def fold_horizon(self) -> int:
        """Reading count after which the rounded running mean cannot move.

        Accepted speeds lie in [0, anomaly_speed_kph] and so does the mean, so
        the step (v - avg) / n is below 0.005 in magnitude once
        n > 200 * anomaly_speed_kph, and rounding to 2 decimals returns the old
        mean. Folding the readings up to this count is therefore exact. (A seed
        mean above the limit widens the interval; see ``pieces.horizon``.)
        """
        return int(math.floor(200.0 * max(self.anomaly_speed_kph, 0.0))) + 1


DEFAULT = Params()
# driver tables are sparse (hours between fixes), so their queries use a one-day timeout
EVENTS_PARAMS = Params(trip_timeout_ms=86_400_000, chunk_ms=SPARSE_CHUNK_MS)
# 2024-02-01T00:00:00Z, the evaluation time of the driver-table run chain
EVENTS_AS_OF_MS = 1_706_745_600_000
# 2024-01-31T00:00:00Z, the evaluation time of the history split: the driver
# data ends on 2024-01-30, so with a one-day timeout some trips are still open
HISTORY_AS_OF_MS = 1_706_659_200_000


def session_conf() -> dict[str, str]:
    """Settings this library expects; callers on a cluster keep their own values."""
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # call sites of every column expression: half the time of building a long plan
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }


def get_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "geotrail"):
    from pyspark.sql import SparkSession

    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("GEOTRAIL_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in session_conf().items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark) -> str:
    """Return the shared checkpoint folder; set a scratch one only when unset (tests)."""
    cur = spark.conf.get("spark.checkpoint.dir", None)
    if not cur:
        cur = spark.sparkContext.getCheckpointDir()
    if not cur:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            # a machine-local folder would not survive executor loss on a cluster
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or object storage)")
        cur = tempfile.mkdtemp(prefix="geotrail-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", cur)
        spark.sparkContext.setCheckpointDir(cur)
    return cur
