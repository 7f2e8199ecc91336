"""Flow indicators over valid trips.

Trips are reduced to one row per key before anything is joined to them, so the
station table never meets the fact table and a busy station costs one partial
row per task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odflow.operators import exact


def endpoint_events(trips: DataFrame) -> DataFrame:
    """``(station_id, side)``: a trip gives one ``out`` and one ``in`` event."""
    return trips.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("origin").alias("station_id"), F.lit("out").alias("side")
                ),
                F.struct(
                    F.col("destination").alias("station_id"), F.lit("in").alias("side")
                ),
            )
        )
    )


def flows_by_station(trips: DataFrame, stations: DataFrame) -> DataFrame:
    """Departures and arrivals per station, with name and zone.

    A station without departures or without arrivals is left out.
    """
    counts = (
        endpoint_events(trips)
        .groupBy("station_id")
        .agg(
            F.count_if(F.col("side") == "out").alias("n_departures"),
            F.count_if(F.col("side") == "in").alias("n_arrivals"),
        )
        .filter((F.col("n_departures") > 0) & (F.col("n_arrivals") > 0))
    )
    return _with_station(counts, stations)


def _with_station(counts: DataFrame, stations: DataFrame) -> DataFrame:
    names = stations.select("station_id", "name", "zone")
    return names.join(counts, "station_id").orderBy("station_id")


def flow_totals(flows: DataFrame) -> DataFrame:
    """One row: all departures and all arrivals."""
    return flows.agg(
        F.sum("n_departures").alias("n_departures"),
        F.sum("n_arrivals").alias("n_arrivals"),
    )


def flow_extremes(flows: DataFrame) -> DataFrame:
    """Stations with the fewest and the most departures and arrivals, ties kept."""
    long = flows.select(
        "station_id",
        F.inline(
            F.array(
                F.struct(
                    F.lit("departures").alias("flow"), F.col("n_departures").alias("n")
                ),
                F.struct(
                    F.lit("arrivals").alias("flow"), F.col("n_arrivals").alias("n")
                ),
            )
        ),
    )
    bounds = (
        long.groupBy("flow")
        .agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
        .select(
            "flow",
            F.inline(
                F.array(
                    F.struct(F.lit("min").alias("bound"), F.col("lo").alias("n")),
                    F.struct(F.lit("max").alias("bound"), F.col("hi").alias("n")),
                )
            ),
        )
    )
    return (
        bounds.join(long, ["flow", "n"])
        .select("flow", "bound", "n", "station_id")
        .orderBy("flow", "bound", "station_id")
    )


def partial_sums(trips: DataFrame, key: str = "origin") -> DataFrame:
    """Sums of durations per key that merge without rounding; see :mod:`exact`."""
    return exact.partial_sums(trips, [key], "duration", "n_trips")


def sum_and_count(trips: DataFrame, key: str = "origin") -> DataFrame:
    """Total duration and trips per key, combined before the shuffle."""
    return exact.totals(partial_sums(trips, key), [key], "total_duration", "n_trips")


def partial_sums_grouped(trips: DataFrame, key: str = "origin") -> DataFrame:
    """:func:`partial_sums` by full grouping: every value crosses the shuffle.

    The rows of a key are spread over as many groups as the session has shuffle
    partitions, and the groups are folded one by one, so no task holds a whole key.
    """
    salts = int(trips.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64("trip_id"), F.lit(salts))
    grouped = trips.select(key, "duration", salt.alias("_salt")).repartition(
        key, "_salt"
    )
    salted = exact.partial_sums(grouped, [key, "_salt"], "duration", "n_trips")
    return exact.merge(salted, [key], "n_trips")


def sum_and_count_grouped(trips: DataFrame, key: str = "origin") -> DataFrame:
    """:func:`sum_and_count` without combining; kept to show what combining saves."""
    return exact.totals(partial_sums_grouped(trips, key), [key], "total_duration", "n_trips")


def mean_by_zone(
    trips: DataFrame,
    stations: DataFrame,
    sums: Callable[[DataFrame, str], DataFrame] = partial_sums,
) -> DataFrame:
    """Total, count and mean duration by zone of origin.

    Sums and counts are merged and divided once at the end; a mean of means
    would weight the stations wrongly.
    """
    zones = stations.select(F.col("station_id").alias("origin"), "zone")
    merged = exact.merge(sums(trips, "origin").join(zones, "origin"), ["zone"], "n_trips")
    return (
        exact.totals(merged, ["zone"], "total_duration", "n_trips")
        .withColumn(
            "mean_duration", F.round(F.col("total_duration") / F.col("n_trips"), 2)
        )
        .orderBy("zone")
    )


def subtotals(trips: DataFrame, stations: DataFrame) -> DataFrame:
    """``(level, month, zone, kind, n_trips, total_duration, mean_duration)`` of all levels.

    One row for every combination of month, zone of origin and kind, and for all subtotals
    over any of them. ``level`` has a bit for each column that is summed over: 4 month,
    2 zone, 1 kind; so 7 is the grand total, and a null value is told from a subtotal.
    The trips are scanned and grouped once; zones join the small result, and all levels
    come from its exact partial sums.
    """
    keys = ["month", "zone", "kind"]
    zones = stations.select(F.col("station_id").alias("origin"), "zone")
    fine = exact.partial_sums(trips, ["month", "origin", "kind"], "duration", "n_trips")
    fine = exact.merge(fine.join(zones, "origin"), keys, "n_trips")
    sums = ", ".join(f"sum({c}) AS {c}" for c in [*exact.SUMS, "n_trips"])
    every = trips.sparkSession.sql(
        f"""
        SELECT {", ".join(keys)}, place, {sums},
          4 * grouping(month) + 2 * grouping(zone) + grouping(kind) AS level
        FROM {{fine}} GROUP BY place, CUBE ({", ".join(keys)})
        """,
        fine=fine,
    ).withColumn("level", F.col("level").cast("int"))
    return exact.totals(every, ["level", *keys], "total_duration", "n_trips").withColumn(
        "mean_duration", F.round(F.col("total_duration") / F.col("n_trips"), 2)
    )


def departures(trips: DataFrame, prefix: str = "") -> DataFrame:
    """Trips per origin, for origins that begin with ``prefix``."""
    return (
        trips.filter(F.col("origin").startswith(prefix))
        .groupBy("origin")
        .agg(F.count("*").alias("n_trips"))
    )


def pair_counts(trips: DataFrame) -> DataFrame:
    """Trips per (origin, destination)."""
    return trips.groupBy("origin", "destination").agg(F.count("*").alias("n_trips"))


def top_pairs(trips: DataFrame, stations: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most frequent pairs with names and rank; ties by station ids.

    The names of both ends of the n ranked rows come from one pass over the stations.
    """
    order = [F.desc("n_trips"), F.col("origin"), F.col("destination")]
    top = pair_counts(trips).orderBy(*order).limit(n)
    # The window sees the n rows that are left, not the pairs.
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    end = [
        F.struct(F.lit(side).alias("side"), F.col(side).alias("station_id"))
        for side in ("origin", "destination")
    ]
    named = ranked.select("*", F.inline(F.array(*end))).join(
        stations.select("station_id", "name"), "station_id"
    )
    row = ["rank", "origin", "destination", "n_trips"]
    names = named.groupBy(*row).pivot("side", ["origin", "destination"]).agg(F.first("name"))
    both = names.toDF(*row, "origin_name", "destination_name").dropna(
        subset=["origin_name", "destination_name"]
    )
    return both.select(
        "rank", "origin", "origin_name", "destination", "destination_name", "n_trips"
    ).orderBy("rank")


def trips_per_month(layer: DataFrame) -> DataFrame:
    """Trips per month of the layer."""
    return (
        layer.groupBy("month").agg(F.count("*").alias("n_trips")).orderBy("month")
    )


def speed_range(trips: DataFrame) -> DataFrame:
    """Slowest and fastest mean speed in km/h, for durations in minutes."""
    speed = F.col("distance") * 60 / F.col("duration")
    return trips.agg(F.min(speed).alias("min_speed"), F.max(speed).alias("max_speed"))
