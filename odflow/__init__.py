"""Origin-destination trip analysis as Spark DataFrame operators."""

from odflow.spec import REASONS, STATION_SCHEMA, TRIP_SCHEMA, TripSpec

__all__ = ["REASONS", "STATION_SCHEMA", "TRIP_SCHEMA", "TripSpec"]
