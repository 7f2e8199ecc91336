"""The whole chain: files in, quality report, indicators, layer and graph out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from odflow.operators import compare, graph, indicators, profile, quality
from odflow.sources import lines as line_source
from odflow.sources import tables
from odflow.sources.scratch import materialize
from odflow.spec import TRIP_FIELDS, TripSpec


# Lines shown of each anomaly.
SAMPLES = {"unknown_station": 5, "bad_duration": 10, "bad_distance": 10, "bad_date": 10}


@dataclass(frozen=True)
class Inputs:
    """One data set: lines as scanned, numbered and checked, repeated ids, and the stations."""

    raw: DataFrame
    lines: DataFrame
    checked: DataFrame
    repeated: DataFrame
    stations: DataFrame
    header: str | None


def load(
    spark: SparkSession,
    trips_path: str,
    stations_path: str,
    spec: TripSpec = TripSpec(),
    header: str | None = None,
) -> Inputs:
    """Read the files and check every line.

    The checked lines feed all later steps, so they are written once: the text
    is parsed a single time, and later steps read only the columns they need. The
    repeated ids are settled once, too, and written as a table of their own.
    Without ``header`` the first line of the data is taken as the header.
    """
    stations = tables.read_stations(spark, stations_path)
    if header is None:
        header = line_source.first_line(spark, trips_path)
    raw = line_source.read_lines(spark, trips_path, header)
    lines = line_source.number_lines(raw)
    checked = materialize(quality.check_lines(lines, stations, spec), "checked")
    repeated = materialize(quality.repeated_ids(checked), "repeated-ids")
    return Inputs(raw, checked.select("line_no", "raw"), checked, repeated, stations, header)


def quality_results(inputs: Inputs) -> dict[str, DataFrame]:
    """Reject counts by rule, rejected lines, and the control totals.

    The rejected lines are written before they are sorted, since a sort reads twice.
    """
    settled = inputs.checked, inputs.repeated
    rejected = materialize(quality.reject_rows(*settled), "rejects")
    return {
        "reject_summary": quality.reject_summary(*settled),
        "rejects": rejected.orderBy("line_no"),
        "reconciliation": quality.reconcile(inputs.raw, *settled),
    }


def profile_results(inputs: Inputs) -> dict[str, DataFrame]:
    """What the raw lines look like before the rules; blanks for every column of the header."""
    columns = profile.header_columns(inputs.header) if inputs.header else TRIP_FIELDS
    complete = profile.complete_lines(inputs.lines)
    marked = profile.mark_anomalies(complete, inputs.stations)
    return {
        "profile_field_counts": profile.field_counts(inputs.lines),
        "profile_blanks": profile.blank_counts(inputs.lines, columns),
        "profile_kinds": profile.value_counts(complete, "kind"),
        "profile_anomalies": profile.anomaly_counts(marked),
        "profile_anomaly_samples": profile.anomaly_samples(marked, SAMPLES),
        "profile_date_range": profile.date_range(complete),
        "profile_duplicates": profile.repeated_ids(inputs.lines),
        "profile_tail": profile.tail(inputs.lines),
    }


def indicator_results(trips: DataFrame, stations: DataFrame) -> dict[str, DataFrame]:
    """Flows, mean duration by zone, top pairs."""
    return {
        "flows_by_station": indicators.flows_by_station(trips, stations),
        "mean_by_zone": indicators.mean_by_zone(trips, stations),
        "top_pairs": indicators.top_pairs(trips, stations),
    }


def graph_results(trips: DataFrame, stations: DataFrame) -> dict[str, DataFrame]:
    """Arcs, degrees and the reports made from them.

    The arcs are counted once and kept: every report starts from them.
    """
    vertices = graph.vertices(stations)
    arcs = materialize(graph.arcs(trips), "arcs")
    degrees = graph.degrees(vertices, arcs)
    return {
        "graph_summary": graph.summary(vertices, arcs),
        "graph_arcs": graph.sorted_arcs(arcs),
        "graph_degrees": degrees,
        "graph_completeness": graph.completeness(vertices, degrees),
        "graph_top": graph.top_vertices(degrees),
        "graph_heaviest": graph.heaviest_arcs(arcs),
    }


def typed_trips(
    spark: SparkSession, trips_path: str, stations: DataFrame, spec: TripSpec
) -> DataFrame:
    """Valid trips by the other way: CSV reader and columnar rules.

    Header lines are read as data, whichever files have one; the rules drop them.
    """
    return quality.clean_typed(
        tables.read_trips(spark, trips_path, header=False),
        stations,
        spec,
        ["file_path", "block_start", "scan_row"],
    )


def run(
    spark: SparkSession,
    trips_path: str,
    stations_path: str,
    output: str,
    spec: TripSpec = TripSpec(),
    header: str | None = None,
) -> dict[str, DataFrame]:
    """Run all steps and write every result below ``output``.

    The valid trips become a Parquet layer by month (``output/layer``), which
    the indicators and the graph read; the other results are CSV folders. Without
    ``header`` one more scan of the trips finds the first line, which is taken for it.
    """
    inputs = load(spark, trips_path, stations_path, spec, header)
    trips = quality.valid_trips(inputs.checked, inputs.repeated)
    tables.write_month_layer(trips, f"{output}/layer")
    layer = tables.read_month_layer(spark, f"{output}/layer", trips.schema)

    from_lines = indicator_results(layer, inputs.stations)
    typed = materialize(
        typed_trips(spark, trips_path, inputs.stations, spec).select(*TRIP_FIELDS),
        "typed-trips",
    )
    from_table = indicator_results(typed, inputs.stations)
    results = {
        **quality_results(inputs),
        **profile_results(inputs),
        **from_lines,
        **graph_results(layer, inputs.stations),
        "flow_totals": indicators.flow_totals(from_lines["flows_by_station"]),
        "months": tables.months(layer),
        "trips_per_month": indicators.trips_per_month(layer),
        "speed_range": indicators.speed_range(layer),
        "comparison": compare.compare_all(
            {name: (from_lines[name], from_table[name]) for name in from_lines}
        ),
    }
    for name, result in results.items():
        tables.write_result(result, f"{output}/{name}")
    return results
