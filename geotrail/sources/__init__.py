"""Inputs and outputs: the driver-table adapter, ingest (I1-I4) and table storage."""

from geotrail.sources.events import (
    events_positions,
    events_positions_raw,
    events_positions_with_resends,
    events_run_split,
)
from geotrail.sources.ingest import dedupe, ingest_outcomes, normalize

__all__ = [
    "dedupe",
    "events_positions",
    "events_positions_raw",
    "events_positions_with_resends",
    "events_run_split",
    "ingest_outcomes",
    "normalize",
]
