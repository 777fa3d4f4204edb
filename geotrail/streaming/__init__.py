"""Structured Streaming form of the incremental trip fold."""

from geotrail.streaming.stateful import OUTPUT_SCHEMA, trip_stream, write_trip_stream

__all__ = ["OUTPUT_SCHEMA", "trip_stream", "write_trip_stream"]
