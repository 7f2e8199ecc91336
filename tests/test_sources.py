"""Line numbers, headers, typed CSV, month layer, scratch tables."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException

from odflow.operators import indicators, quality
from odflow.sources import lines as line_source
from odflow.sources import scratch, tables
from odflow.spec import TRIP_SCHEMA, TripSpec

HEADER = "trip_id,ts,origin,destination,duration,distance,kind"


@pytest.fixture
def small_splits(spark):
    saved = {
        k: spark.conf.get(k)
        for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    }
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    spark.conf.set("spark.sql.files.openCostInBytes", "64")
    yield
    for key, value in saved.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_line_numbers_over_files_and_splits(spark, tmp_path, small_splits, end):
    expected, n = {}, 0
    for file, size in {"a": 700, "b": 3, "c": 0, "d": 1500, "e": 40}.items():
        rows = [HEADER]
        for i in range(size):
            n += 1
            text = "" if i % 97 == 5 else f"{file}{i}" + "x" * (i % 13)
            expected[n] = text
            rows.append(text)
        (tmp_path / f"{file}.csv").write_bytes((end.join(rows) + end).encode())
    path = str(tmp_path)
    lines = line_source.read_lines(spark, path, HEADER)
    assert lines.rdd.getNumPartitions() > 8
    got = {r["line_no"]: r["raw"] for r in line_source.number_lines(lines).collect()}
    assert got == expected
    assert line_source.line_count(lines).first()["n_lines"] == n


def test_numbers_do_not_depend_on_the_broadcast(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text("".join(f"line {i}\n" for i in range(1, 2001)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = line_source.number_lines(line_source.read_lines(spark, str(tmp_path)))
        rows = numbered.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted((r["line_no"], r["raw"]) for r in rows) == [
        (i, f"line {i}") for i in range(1, 2001)
    ]


def test_changed_splits_stop_the_query(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text("".join(f"line {i}\n" for i in range(1, 2001)))
    numbered = line_source.number_lines(line_source.read_lines(spark, str(tmp_path)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1300")
    with pytest.raises(PySparkException, match="input splits changed"):
        numbered.agg({"line_no": "max"}).collect()


def test_header(spark, tmp_path):
    (tmp_path / "b.csv").write_text("x\ny\n")
    (tmp_path / "a.csv").write_text("head\n1\nhead\n2\n")
    path = str(tmp_path)
    assert line_source.first_line(spark, path) == "head"
    lines = line_source.read_lines(spark, path, "head")
    assert sorted(r["raw"] for r in lines.collect()) == ["1", "2", "x", "y"]
    all_lines = line_source.read_lines(spark, path)
    kept = line_source.drop_header_prefix(all_lines, "he").collect()
    assert sorted(r["raw"] for r in kept) == ["1", "2", "x", "y"]


def test_header_skips_empty_files_and_odd_names(spark, tmp_path):
    for name, text in {"a.csv": "", "b[1] x.csv": "head\n1\n", "c.csv": "2\n"}.items():
        (tmp_path / name).write_text(text)
    assert line_source.first_line(spark, str(tmp_path)) == "head"
    lines = line_source.read_lines(spark, str(tmp_path), "head")
    numbered = line_source.number_lines(lines).orderBy("line_no").collect()
    assert [tuple(r) for r in numbered] == [(1, "1"), (2, "2")]


def test_no_header_without_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert line_source.first_line(spark, str(tmp_path)) is None


def test_stations_fail_fast(spark, tmp_path):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    head = "station_id,nom,zone,latitude,longitude\r\n"
    good.write_text(head + "S1,One,1,48.8,2.3\r\n")
    bad.write_text(head + "S1,One,first,48.8,2.3\r\n")
    assert tables.read_stations(spark, str(good)).first()["zone"] == 1
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        tables.read_stations(spark, str(bad)).collect()
    inferred = tables.read_inferred(spark, str(good))
    assert dict(inferred.dtypes)["zone"] == "int"


def test_trips_csv_is_permissive_and_ordered(spark, tmp_path, small_splits):
    rows = [f"T{i},2026-02-01 10:00:00,S1,S2,{i},1.5,annuel" for i in range(1, 400)]
    rows[6] = "T7,2026-02-01 10:00:00,S1,S2,inconnu,1.5,annuel"
    (tmp_path / "t.csv").write_text("\n".join([HEADER, *rows]) + "\n")
    trips = tables.read_trips(spark, str(tmp_path))
    ordered = trips.orderBy("file_path", "block_start", "scan_row").collect()
    assert [r["trip_id"] for r in ordered] == [f"T{i}" for i in range(1, 400)]
    assert ordered[6]["duration"] is None
    assert ordered[0]["ts"] == datetime(2026, 2, 1, 10)


def test_header_in_the_first_file_only(spark, tmp_path):
    stations = spark.createDataFrame([("S1",), ("S2",)], "station_id STRING")
    for n, head in enumerate([HEADER + "\n", "", HEADER + "\n"]):
        row = f"T{n},2026-02-01 10:00:00,S1,S2,3,1.5,annuel\n"
        (tmp_path / f"{n}.csv").write_text(head + row)
    trips = tables.read_trips(spark, str(tmp_path), header=False)
    clean = quality.clean_typed(trips, stations, TripSpec(), ["file_path", "scan_row"])
    assert sorted(r["trip_id"] for r in clean.collect()) == ["T0", "T1", "T2"]


@pytest.fixture
def trips(spark):
    rows = [
        (f"T{i}", datetime(2026, 1 + i % 3, 1 + i % 28, 12), "S1", "S2", 1.0, 1.0, "x")
        for i in range(90)
    ]
    return spark.createDataFrame(rows, TRIP_SCHEMA)


def test_month_layer(spark, tmp_path, trips):
    path = str(tmp_path / "layer")
    for _ in range(2):  # overwrites
        tables.write_month_layer(trips, path)
    layer = tables.read_month_layer(spark, path, trips.schema)
    assert [r["month"] for r in tables.months(layer).collect()] == [
        "2026-01",
        "2026-02",
        "2026-03",
    ]
    counts = indicators.trips_per_month(layer).collect()
    assert [r["n_trips"] for r in counts] == [30, 30, 30]
    assert layer.drop("month").exceptAll(trips).isEmpty()


def test_period_reads_only_its_months(spark, tmp_path, trips):
    path = str(tmp_path / "layer")
    tables.write_month_layer(trips, path)
    layer = tables.read_month_layer(spark, path, trips.schema)
    part = tables.in_period(layer, datetime(2026, 2, 1), datetime(2026, 3, 1))
    assert {f.split("month=")[1][:7] for f in part.inputFiles()} >= {"2026-02"}
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    assert {r["month"] for r in part.select("month").distinct().collect()} == {"2026-02"}
    assert part.count() == 30


def test_result_files(spark, tmp_path):
    result = spark.createDataFrame([(1, "a,b"), (2, 'c"d')], "rank INT, name STRING")
    path = str(tmp_path / "result")
    tables.write_result(result, path)
    back = tables.read_result(spark, path, result.schema)
    assert sorted(map(tuple, back.collect())) == [(1, "a,b"), (2, 'c"d')]


def test_scratch_follows_the_session(spark, tmp_path):
    saved = spark.conf.get("spark.checkpoint.dir", None)
    spark_conf = {"spark.checkpoint.dir": "hdfs://shared/tmp/"}

    class Session:
        def __init__(self, conf):
            self.conf = conf

    assert scratch.scratch_root(Session(spark_conf)) == "hdfs://shared/tmp"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_root(Session({"spark.master": "yarn"}))
    local = scratch.scratch_root(Session({"spark.master": "local[2]"}))
    assert local == scratch.scratch_root(Session({"spark.master": "local[2]"}))
    assert spark.conf.get("spark.checkpoint.dir", None) == saved


def test_materialize_keeps_schema_and_rows(spark, trips):
    kept = scratch.materialize(trips, "test")
    assert kept.schema == trips.schema
    assert kept.exceptAll(trips).isEmpty() and kept.count() == trips.count()
