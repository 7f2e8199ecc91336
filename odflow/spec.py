"""Schemas, reject reasons and the parameters of a trip data set.

Operators use one set of column names throughout:

* trips: ``trip_id, ts, origin, destination, duration, distance, kind``
* stations: ``station_id, name, zone, latitude, longitude``

Tables with other names are renamed once, where they are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# The reject reasons, in the order in which the rules apply.
FORMAT = "format_invalide"
DATE = "date_invalide"
PERIOD = "hors_periode"
STATION = "station_inconnue"
NOT_NUMERIC = "valeur_non_numerique"
NOT_POSITIVE = "valeur_non_positive"
LOOP = "boucle"
KIND = "abonnement_inconnu"
DUPLICATE = "doublon_id"
REASONS = (
    FORMAT,
    DATE,
    PERIOD,
    STATION,
    NOT_NUMERIC,
    NOT_POSITIVE,
    LOOP,
    KIND,
    DUPLICATE,
)

# Field order of a trip line.
TRIP_FIELDS = (
    "trip_id",
    "ts",
    "origin",
    "destination",
    "duration",
    "distance",
    "kind",
)

TRIP_SCHEMA = StructType(
    [
        StructField("trip_id", StringType()),
        StructField("ts", TimestampNTZType()),
        StructField("origin", StringType()),
        StructField("destination", StringType()),
        StructField("duration", DoubleType()),
        StructField("distance", DoubleType()),
        StructField("kind", StringType()),
    ]
)

STATION_SCHEMA = StructType(
    [
        StructField("station_id", StringType(), False),
        StructField("name", StringType(), False),
        StructField("zone", IntegerType(), False),
        StructField("latitude", DoubleType(), False),
        StructField("longitude", DoubleType(), False),
    ]
)


@dataclass(frozen=True)
class TripSpec:
    """What counts as a valid trip: the period (end excluded) and the kinds.

    The defaults are fixed values of the published data set.
    """

    start: datetime = datetime(2026, 1, 1)
    end: datetime = datetime(2026, 4, 1)
    kinds: tuple[str, ...] = ("annuel", "mensuel", "occasionnel")
