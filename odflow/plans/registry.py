"""The registered queries: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from odflow.operators import compare, dedup, graph, indicators, profile, quality
from odflow.plans import given_tables as given
from odflow.sources import lines as line_source
from odflow.sources import tables
from odflow.sources.scratch import materialize, scratch_path
from odflow.spec import TRIP_FIELDS, TRIP_SCHEMA

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

HEADER = ",".join(TRIP_FIELDS)
MONTH_START, MONTH_END = datetime(2000, 1, 1), datetime(2000, 2, 1)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Inputs shared by the queries.


def valid_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.clean_typed(
        given.trips(spark, sf_dir),
        given.stations(spark, sf_dir),
        given.TRIPS_SPEC,
        given.TRIP_ORDER,
    )


def month_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of one month: few enough that the graph is not complete."""
    return valid_trips(spark, sf_dir).filter(F.col("month") == f"{MONTH_START:%Y-%m}")


def checked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_lines(
        given.lines(spark, sf_dir), given.line_stations(spark, sf_dir), given.LINES_SPEC
    )


def _classified(checked: DataFrame) -> DataFrame:
    """All lines with their final reason; the repeated ids are written first."""
    return quality.classify(checked, materialize(quality.repeated_ids(checked), "repeated-ids"))


def text_files(spark: SparkSession, sf_dir: str) -> str:
    """The raw lines as text files, a header first; returns their folder."""
    path = scratch_path(spark, "lines")
    header = spark.createDataFrame([(0, HEADER)], "line_no BIGINT, raw STRING")
    (
        given.lines(spark, sf_dir)
        .unionByName(header)
        .orderBy("line_no")
        .select("raw")
        .write.text(path)
    )
    return path


def read_numbered(spark: SparkSession, path: str) -> DataFrame:
    return line_source.number_lines(line_source.read_lines(spark, path, HEADER))


# Quality.


@query
def clean_trips(spark, sf_dir):
    return valid_trips(spark, sf_dir)


@query
def classify_lines(spark, sf_dir):
    return _classified(checked_lines(spark, sf_dir)).select("line_no", "reason")


@query
def valid_lines(spark, sf_dir):
    return quality.valid_trips(checked_lines(spark, sf_dir))


@query
def reject_summary(spark, sf_dir):
    return quality.reject_summary(checked_lines(spark, sf_dir))


@query
def reject_detail(spark, sf_dir):
    checked = checked_lines(spark, sf_dir)
    repeated = materialize(quality.repeated_ids(checked), "repeated-ids")
    return materialize(quality.reject_rows(checked, repeated), "rejects").orderBy("line_no")


@query
def reconciliation(spark, sf_dir):
    return quality.reconcile(given.lines(spark, sf_dir), checked_lines(spark, sf_dir))


@query
def first_occurrence(spark, sf_dir):
    passing = quality.passing(checked_lines(spark, sf_dir))
    return dedup.first_occurrence(
        passing.select("trip_id", "line_no"), "trip_id", ["line_no"]
    )


# Indicators.


@query
def mean_duration_by_zone(spark, sf_dir):
    return indicators.mean_by_zone(
        valid_trips(spark, sf_dir), given.stations(spark, sf_dir)
    )


@query
def flows_by_station(spark, sf_dir):
    return indicators.flows_by_station(
        valid_trips(spark, sf_dir), given.stations(spark, sf_dir)
    )


@query
def flow_totals(spark, sf_dir):
    return indicators.flow_totals(flows_by_station(spark, sf_dir))


@query
def flow_extremes(spark, sf_dir):
    return indicators.flow_extremes(flows_by_station(spark, sf_dir))


@query
def top10_pairs(spark, sf_dir):
    return indicators.top_pairs(
        valid_trips(spark, sf_dir), given.stations(spark, sf_dir), 10
    )


@query
def sum_count_combined(spark, sf_dir):
    return indicators.sum_and_count(valid_trips(spark, sf_dir))


@query
def sum_count_grouped(spark, sf_dir):
    return indicators.sum_and_count_grouped(valid_trips(spark, sf_dir))


@query
def departures_by_prefix(spark, sf_dir):
    return indicators.departures(
        quality.valid_trips(checked_lines(spark, sf_dir)), prefix="S1"
    )


# Month layer.


def _layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = valid_trips(spark, sf_dir)
    path = scratch_path(spark, "layer")
    tables.write_month_layer(trips, path)
    return tables.read_month_layer(spark, path, trips.schema)


@query
def month_layer_counts(spark, sf_dir):
    return indicators.trips_per_month(_layer(spark, sf_dir))


@query
def month_list(spark, sf_dir):
    return tables.months(_layer(spark, sf_dir))


@query
def month_pruned_scan(spark, sf_dir):
    return tables.in_period(_layer(spark, sf_dir), MONTH_START, MONTH_END).select(
        *TRIP_FIELDS
    )


# Profile of raw lines.


def _complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.complete_lines(given.lines(spark, sf_dir))


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.mark_anomalies(
        _complete(spark, sf_dir), given.line_stations(spark, sf_dir)
    )


@query
def line_count(spark, sf_dir):
    return line_source.line_count(given.lines(spark, sf_dir))


@query
def profile_field_counts(spark, sf_dir):
    return profile.field_counts(given.lines(spark, sf_dir))


@query
def profile_kinds(spark, sf_dir):
    return profile.value_counts(_complete(spark, sf_dir), "kind")


@query
def profile_blanks(spark, sf_dir):
    return profile.blank_counts(given.lines(spark, sf_dir))


@query
def profile_anomalies(spark, sf_dir):
    return profile.anomaly_counts(_marked(spark, sf_dir))


@query
def profile_anomaly_samples(spark, sf_dir):
    sizes = {
        "unknown_station": 5,
        "bad_duration": 10,
        "bad_distance": 10,
        "bad_date": 10,
    }
    return profile.anomaly_samples(_marked(spark, sf_dir), sizes)


@query
def profile_duplicates(spark, sf_dir):
    return profile.repeated_ids(given.lines(spark, sf_dir))


@query
def profile_date_range(spark, sf_dir):
    return profile.date_range(_complete(spark, sf_dir))


@query
def profile_speed_range(spark, sf_dir):
    return indicators.speed_range(valid_trips(spark, sf_dir))


@query
def profile_tail(spark, sf_dir):
    return profile.tail(given.lines(spark, sf_dir), 5)


# Graph.


def _degrees(spark: SparkSession, sf_dir: str, trips: Query) -> DataFrame:
    vertices = graph.vertices(given.stations(spark, sf_dir))
    return graph.degrees(vertices, graph.arcs(trips(spark, sf_dir)))


@query
def graph_vertices(spark, sf_dir):
    return graph.vertices(given.stations(spark, sf_dir))


@query
def graph_arcs(spark, sf_dir):
    return graph.sorted_arcs(graph.arcs(valid_trips(spark, sf_dir)))


@query
def graph_heaviest(spark, sf_dir):
    return graph.heaviest_arcs(graph.arcs(valid_trips(spark, sf_dir)), 5)


@query
def graph_degrees(spark, sf_dir):
    return _degrees(spark, sf_dir, valid_trips)


@query
def graph_degrees_sparse(spark, sf_dir):
    return _degrees(spark, sf_dir, month_trips)


@query
def graph_summary(spark, sf_dir):
    return graph.summary(
        graph.vertices(given.stations(spark, sf_dir)),
        graph.arcs(valid_trips(spark, sf_dir)),
    )


@query
def graph_completeness(spark, sf_dir):
    vertices = graph.vertices(given.stations(spark, sf_dir))
    cases = {"all": valid_trips, "month": month_trips}
    whole, month = (
        graph.completeness(vertices, _degrees(spark, sf_dir, trips)).select(
            F.lit(case).alias("trips"), "complete"
        )
        for case, trips in cases.items()
    )
    return whole.unionByName(month)


@query
def graph_top5(spark, sf_dir):
    return graph.top_vertices(_degrees(spark, sf_dir, valid_trips), 5)


@query
def graph_top5_sparse(spark, sf_dir):
    return graph.top_vertices(_degrees(spark, sf_dir, month_trips), 5)


def _degrees_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    vertices = graph.vertices(given.stations(spark, sf_dir))
    arcs = graph.arcs(valid_trips(spark, sf_dir), ("month",))
    return graph.degrees(vertices, arcs, ("month",))


@query
def graph_degrees_by_month(spark, sf_dir):
    """The graphs of all months, none of them complete."""
    return _degrees_by_month(spark, sf_dir)


@query
def graph_top5_by_month(spark, sf_dir):
    return graph.top_vertices_by(_degrees_by_month(spark, sf_dir), ("month",), 5)


# Comparison of variants.


def _flows_from_arcs(arcs: DataFrame, stations: DataFrame) -> DataFrame:
    """Departures and arrivals per station as sums over the weights of the arcs."""
    ends = [
        F.struct(F.col(end).alias("station_id"), out.alias("out"), back.alias("back"))
        for end, out, back in (
            (arcs.columns[0], F.col(arcs.columns[2]), F.lit(0).cast("bigint")),
            (arcs.columns[1], F.lit(0).cast("bigint"), F.col(arcs.columns[2])),
        )
    ]
    sums = (
        arcs.select(F.inline(F.array(*ends)))
        .groupBy("station_id")
        .agg(F.sum("out").alias("n_departures"), F.sum("back").alias("n_arrivals"))
        .filter("n_departures > 0 AND n_arrivals > 0")
    )
    return stations.select("station_id", "name", "zone").join(sums, "station_id")


@query
def compare_results(spark, sf_dir):
    """Results stored as CSV and read back, against a second way to get them."""
    trips = materialize(valid_trips(spark, sf_dir), "valid-trips")
    stations = given.stations(spark, sf_dir)

    def stored(result: DataFrame, label: str) -> DataFrame:
        path = scratch_path(spark, label)
        tables.write_result(result, path)
        return tables.read_result(spark, path, result.schema)

    names = ["rank", "origin", "destination", "n_trips"]
    arcs = graph.arcs(trips)
    # Ranked on its own, over the ten rows that are left.
    by_weight = graph.heaviest_arcs(arcs, 10).toDF(*names[1:])
    order = Window.orderBy(F.desc("n_trips"), "origin", "destination")
    ranked = by_weight.select(F.row_number().over(order).alias("rank"), *names[1:])
    top = indicators.top_pairs(trips, stations, 10)
    return compare.compare_all(
        {
            "flows": (
                stored(indicators.flows_by_station(trips, stations), "flows"),
                _flows_from_arcs(arcs, stations),
            ),
            "zones": (
                stored(indicators.mean_by_zone(trips, stations), "zones"),
                indicators.mean_by_zone(
                    trips, stations, indicators.partial_sums_grouped
                ),
            ),
            "pairs": (stored(top, "pairs").select(names), ranked),
        }
    )


@query
def compare_first_occurrence(spark, sf_dir):
    passing = quality.passing(checked_lines(spark, sf_dir)).select("trip_id", "line_no")
    return compare.compare_all(
        {
            "first_occurrence": (
                dedup.first_occurrence(passing, "trip_id", ["line_no"]),
                dedup.first_by_minimum(passing, "trip_id", "line_no"),
            )
        }
    )


@query
def cache_invariance(spark, sf_dir):
    """Two indicators from trips computed anew and from trips kept in storage."""
    anew = valid_trips(spark, sf_dir)
    kept = materialize(anew, "valid-trips")
    two = (indicators.departures, indicators.pair_counts)
    return compare.compare_all({f.__name__: (f(anew), f(kept)) for f in two})


@query
def partition_invariance(spark, sf_dir):
    """Mean by zone under 8 and under 200 shuffle partitions."""
    results = []
    for n in (8, 200):
        session = spark.newSession()
        session.conf.set("spark.sql.shuffle.partitions", n)
        path = scratch_path(session, f"zones-{n}")
        mean_duration_by_zone(session, sf_dir).write.parquet(path)
        zones = spark.read.parquet(path)
        results.append(zones.select(F.lit(n).alias("shuffle_partitions"), "*"))
    first, second = results
    return first.unionByName(second)


# Files.


@query
def lines_numbered(spark, sf_dir):
    return read_numbered(spark, text_files(spark, sf_dir))


@query
def lines_without_prefix(spark, sf_dir):
    lines = line_source.read_lines(spark, text_files(spark, sf_dir))
    return line_source.drop_header_prefix(lines, TRIP_FIELDS[0]).select("raw")


@query
def classify_text(spark, sf_dir):
    """Rules on lines read from text files, numbered in file order."""
    checked = quality.check_lines(
        read_numbered(spark, text_files(spark, sf_dir)),
        given.line_stations(spark, sf_dir),
        given.LINES_SPEC,
    )
    return _classified(checked).select("line_no", "reason")


@query
def clean_csv(spark, sf_dir):
    """The columnar rules on the same text, read by the CSV reader.

    Only the first file has a header; it is read as data and fails the rules.
    """
    trips = tables.read_trips(spark, text_files(spark, sf_dir), header=False)
    return quality.clean_typed(
        trips,
        given.line_stations(spark, sf_dir),
        given.LINES_SPEC,
        ["file_path", "block_start", "scan_row"],
    )


def _station_csv(spark: SparkSession, sf_dir: str) -> tuple[str, StructType]:
    stations = given.stations(spark, sf_dir)
    path = scratch_path(spark, "stations")
    tables.write_result(stations, path)
    return path, stations.schema


@query
def stations_typed_csv(spark, sf_dir):
    path, schema = _station_csv(spark, sf_dir)
    return tables.read_stations(spark, path, schema)


@query
def stations_inferred_csv(spark, sf_dir):
    return tables.read_inferred(spark, _station_csv(spark, sf_dir)[0])


@query
def trips_typed_csv(spark, sf_dir):
    trips = given.trips(spark, sf_dir).select(
        *(F.col(f.name).cast(f.dataType) for f in TRIP_SCHEMA)
    )
    path = scratch_path(spark, "trips")
    tables.write_result(trips.withColumn("ts", F.col("ts").cast("string")), path)
    return tables.read_trips(spark, path).select(*TRIP_FIELDS)


@query
def station_ids(spark, sf_dir):
    return given.line_stations(spark, sf_dir).select("station_id").distinct()
