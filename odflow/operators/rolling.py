"""Rolling flows per station, without a window over a station's whole history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rolling_departures(trips: DataFrame, days: int = 7) -> DataFrame:
    """``(station_id, day, n_trips, n_rolling, change)`` for every day with departures.

    ``n_rolling`` counts the departures of this day and the ``days - 1`` calendar days
    before; ``change`` is the difference to the day before, where a day without trips counts 0.

    Trips become one row per station and day first. Each of these adds itself to the days
    whose frame holds it, so that days of one station are as many groups as there are days,
    and no border between tasks has to be carried over. Trips without a time or an origin
    count nowhere.
    """
    if days < 1:
        raise ValueError("days must be 1 or more")
    daily = (
        trips.filter(F.col("ts").isNotNull() & F.col("origin").isNotNull())
        .groupBy(F.col("origin").alias("station_id"), F.to_date("ts").alias("day"))
        .agg(F.count("*").alias("n"))
    )
    reach = F.explode(F.sequence(F.lit(0), F.lit(max(days - 1, 1))))
    moved = daily.select("station_id", "day", "n", reach.alias("later"))
    own = F.col("later") == 0
    added = moved.select(
        "station_id",
        F.date_add("day", F.col("later")).alias("day"),
        F.when(own, F.col("n")).alias("own"),
        F.when(F.col("later") < days, F.col("n")).otherwise(0).alias("rolling"),
        F.when(own, F.col("n")).when(F.col("later") == 1, -F.col("n")).otherwise(0).alias("step"),
    )
    return (
        added.groupBy("station_id", "day")
        .agg(
            F.sum("own").alias("n_trips"),
            F.sum("rolling").alias("n_rolling"),
            F.sum("step").alias("change"),
        )
        .filter(F.col("n_trips").isNotNull())
    )


def rolling_arrivals(trips: DataFrame, days: int = 7) -> DataFrame:
    """:func:`rolling_departures` of the destinations."""
    swapped = trips.select("ts", F.col("destination").alias("origin"))
    return rolling_departures(swapped, days)
