"""Timing of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables and ``BENCH_CPUS`` the local cores. Every entry
runs once to warm up and then ``RUNS`` times; the median is reported. The time of
a headline query includes building it; its rows go to the ``noop`` sink.

The ``layer_*`` and ``two_indicators_*`` entries follow the published variants of
8 and 200 shuffle partitions, and two indicators with and without a kept input.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import timeit
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from odflow.operators import indicators, quality
from odflow.plans import given_tables as given
from odflow.plans import registry
from odflow.sources import tables
from odflow.sources.scratch import materialize, scratch_path

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = (
    "mean_duration_by_zone",
    "flows_by_station",
    "top10_pairs",
    "clean_trips",
    "valid_lines",
    "classify_lines",
    "reject_summary",
    "reject_detail",
    "reconciliation",
    "month_layer_counts",
    "profile_blanks",
    "profile_anomalies",
    "graph_arcs",
    "graph_degrees",
    "graph_top5",
    "classify_text",
    "clean_csv",
)


def run(result: DataFrame) -> None:
    result.write.format("noop").mode("overwrite").save()


def median_seconds(action) -> float:
    action()
    return round(statistics.median(timeit.repeat(action, number=1, repeat=RUNS)), 4)


def published_variants(spark: SparkSession) -> dict[str, float]:
    """Small aggregates on a prepared input; every run builds them anew.

    The ``*_same_frame`` entries collect one DataFrame again and again, as the
    published runs of the mean by zone do; Spark then reuses its shuffle files.
    """
    trips = registry.valid_trips(spark, SF_DIR)
    path = scratch_path(spark, "bench-layer")
    tables.write_month_layer(trips, path)
    layer = tables.read_month_layer(spark, path, trips.schema)
    stations = given.stations(spark, SF_DIR)
    anew = quality.valid_trips(registry.checked_lines(spark, SF_DIR))
    kept = materialize(anew, "bench-valid")
    seconds: dict[str, float] = {}

    def timed(name: str, build: Callable[[], list[DataFrame]]) -> None:
        seconds[name] = median_seconds(lambda: [df.collect() for df in build()])

    def zones() -> list[DataFrame]:
        return [indicators.mean_by_zone(layer, stations)]

    def two_indicators(source: DataFrame) -> list[DataFrame]:
        return [indicators.departures(source), indicators.pair_counts(source)]

    timed("layer_sum_count_grouped", lambda: [indicators.sum_and_count_grouped(layer)])
    timed("layer_sum_count_combined", lambda: [indicators.sum_and_count(layer)])
    saved = spark.conf.get("spark.sql.shuffle.partitions")
    for n in (200, 8):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        timed(f"layer_mean_by_zone_{n}", zones)
        same = zones()
        timed(f"layer_mean_by_zone_{n}_same_frame", lambda same=same: same)
    spark.conf.set("spark.sql.shuffle.partitions", saved)
    timed("two_indicators_anew", lambda: two_indicators(anew))
    timed("two_indicators_kept", lambda: two_indicators(kept))
    return seconds


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("odflow-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = [n for n in HEADLINE if not sys.argv[1:] or n in sys.argv[1:]]
    seconds = {
        name: median_seconds(lambda: run(registry.QUERIES[name](spark, SF_DIR)))
        for name in chosen
    }
    if not sys.argv[1:]:
        seconds.update(published_variants(spark))
    spark.stop()
    report = {
        "metric": "total of median query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
