"""geotrail: vehicle GPS fixes -> segments, trips, speed alerts and fleet summaries on Spark.

Batch work is plain DataFrame plans (windows, aggregates, joins) keyed on
``(vin, time chunk)`` so that a single very active vehicle is spread over many
tasks; the streaming form keeps one open trip per vehicle in keyed state.
"""

from geotrail.config import Params

__all__ = ["Params"]
