"""Shape of the physical plans: what keeps the queries fit for large data."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from odflow.operators import indicators, quality
from odflow.plans import registry
from odflow.spec import TripSpec

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables missing")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(queries()[name](spark, SF_DIR))
    for bad in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text, bad


def test_valid_trips_prune_before_the_shuffle(spark):
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    text = plan(registry.valid_trips(spark, SF_DIR))
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    partial = re.search(r"WindowGroupLimit .*row_number\(\), 1, Partial", text)
    shuffle = text.index("Exchange hashpartitioning(trip_id")
    assert partial and partial.start() > shuffle
    assert text.count("Exchange hashpartitioning(trip_id") == 1
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_shipdate", text)
    assert "ReadSchema: struct<n_nationkey:int>" in text


def test_scan_reads_only_the_columns_of_the_query(spark):
    path = registry.scratch_path(spark, "layer")
    trips = registry.valid_trips(spark, SF_DIR)
    registry.tables.write_month_layer(trips, path)
    layer = registry.tables.read_month_layer(spark, path, trips.schema)
    stations = registry.given.stations(spark, SF_DIR)
    text = plan(indicators.mean_by_zone(layer, stations))
    assert "ReadSchema: struct<origin:int,duration:double>" in text
    assert "BroadcastHashJoin" in text


def test_aggregates_combine_before_the_shuffle(spark):
    trips = registry.valid_trips(spark, SF_DIR)
    text = plan(indicators.sum_and_count(trips))
    assert "partial_sum(" in text
    grouped = plan(indicators.sum_and_count_grouped(trips))
    assert "collect_list" not in grouped


def test_top_pairs_sort_only_what_is_kept(spark):
    trips = registry.valid_trips(spark, SF_DIR)
    stations = registry.given.stations(spark, SF_DIR)
    assert "TakeOrderedAndProject(limit=10" in plan(
        indicators.top_pairs(trips, stations)
    )


def test_reject_summary_never_shuffles_the_text(spark):
    checked = registry.checked_lines(spark, SF_DIR)
    text = plan(registry.quality.reason_counts(checked))
    for node in re.findall(r"HashAggregate\(keys=\[([^\]]*)\]", text):
        assert "raw" not in node


@pytest.mark.parametrize(
    "name", ["classify_text", "valid_lines", "reject_detail", "clean_trips"]
)
def test_generated_code_stays_compilable(spark, name):
    """The JVM only interprets methods above 8000 bytes, many times slower."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        execution = queries()[name](spark, SF_DIR)._jdf.queryExecution()
        text = spark._jvm.PythonSQLUtils.explainString(execution, "codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000


def test_samples_prune_before_the_shuffle(spark):
    text = plan(queries()["profile_anomaly_samples"](spark, SF_DIR))
    assert re.search(r"WindowGroupLimit .*row_number\(\), 10, Partial", text)


def test_frequent_id_is_split_when_repeats_are_too_many_to_broadcast(spark):
    """Half the lines share an id; the shuffle join must spread them over tasks."""
    line = "2026-02-01 10:00:00,S1,S2,5,1.5,annuel"
    ids = F.when(F.col("id") % 2 == 0, "hot").otherwise(
        F.concat(F.lit("T"), F.col("id") % 9000)
    )
    lines = spark.range(0, 60000, 1, 12).select(
        (F.col("id") + 1).alias("line_no"),
        F.concat_ws(",", ids, F.lit(line)).alias("raw"),
    )
    stations = spark.createDataFrame([("S1",), ("S2",)], "station_id STRING")
    checked = quality.check_lines(lines, stations, TripSpec())
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        result = quality.rejects(checked)
        rows = result.collect()
        text = plan(result)
    finally:
        for key in small:
            spark.conf.unset(key)
    assert "skew=true" in text
    # 30 000 lines of one id and 30 000 lines of 4 500 ids: one of each is valid.
    assert len(rows) == 60000 - 1 - 4500
    assert {r["reason"] for r in rows} == {"doublon_id"}
    assert [r["line_no"] for r in rows] == sorted(r["line_no"] for r in rows)
