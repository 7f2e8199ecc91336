"""Duplicates, valid / reject split, summary and the columnar variant."""

import random
from datetime import datetime

import pytest

from odflow.operators import dedup, quality
from odflow.spec import REASONS, TRIP_FIELDS, TripSpec

SPEC = TripSpec()


def raw(trip_id, origin="S1", destination="S2", duration="10"):
    return f"{trip_id},2026-02-01 10:00:00,{origin},{destination},{duration},2.5,annuel"


@pytest.fixture(scope="module")
def stations(spark):
    return spark.createDataFrame([(f"S{i}",) for i in range(4)], "station_id STRING")


def frame(spark, raw_lines):
    return spark.createDataFrame(
        list(enumerate(raw_lines, 1)), "line_no BIGINT, raw STRING"
    )


LINES = [
    raw("A", duration="0"),  # invalid: must not hide line 3
    raw("B"),
    raw("A", destination="S3"),
    raw("B", destination="S3"),  # other content, same id
    raw("A"),
    raw("C", origin="S9"),
    raw("B"),
    "",
]


@pytest.fixture(scope="module")
def checked(spark, stations):
    return quality.check_lines(frame(spark, LINES), stations, SPEC)


def test_invalid_line_does_not_hide_a_later_one(checked):
    kept = {r["trip_id"]: r["destination"] for r in quality.valid_trips(checked).collect()}
    assert kept == {"A": "S3", "B": "S2"}


def test_rejects_in_file_order(checked):
    got = [(r["line_no"], r["reason"]) for r in quality.rejects(checked).collect()]
    assert got == [
        (1, "valeur_non_positive"),
        (4, "doublon_id"),
        (5, "doublon_id"),
        (6, "station_inconnue"),
        (7, "doublon_id"),
        (8, "format_invalide"),
    ]


def test_classify_keeps_every_line(checked):
    got = {r["line_no"]: r["reason"] for r in quality.classify(checked).collect()}
    assert len(got) == len(LINES)
    assert {n for n, reason in got.items() if reason is None} == {2, 3}


def test_summary_lists_all_rules_in_order(checked):
    rows = quality.reject_summary(checked).collect()
    assert [r["reason"] for r in rows] == list(REASONS)
    counts = {r["reason"]: r["n_lines"] for r in rows if r["n_lines"]}
    assert counts == {
        "valeur_non_positive": 1,
        "doublon_id": 3,
        "station_inconnue": 1,
        "format_invalide": 1,
    }


def test_summary_of_nothing_is_all_zero(spark, stations):
    empty = quality.check_lines(frame(spark, LINES).limit(0), stations, SPEC)
    assert [r["n_lines"] for r in quality.reject_summary(empty).collect()] == [0] * 9
    row = quality.reconcile(frame(spark, LINES).limit(0), empty).first()
    assert (row["n_lines"], row["n_valid"], row["n_rejected"]) == (0, 0, 0)
    assert row["balanced"]


def test_reconcile(spark, checked):
    row = quality.reconcile(frame(spark, LINES), checked).first()
    assert row.asDict() == {
        "n_lines": 8,
        "n_valid": 2,
        "n_rejected": 6,
        "balanced": True,
    }


def test_repeated_station_does_not_multiply_lines(spark):
    twice = spark.createDataFrame([("S1",), ("S1",), ("S2",)], "station_id STRING")
    checked = quality.check_lines(frame(spark, [raw("A")]), twice, SPEC)
    assert checked.count() == 1


def test_first_occurrence_with_a_very_frequent_key(spark):
    rng = random.Random(3)
    rows = [
        (rng.choice(["hot", f"id{i % 700}", f"id{i % 900}"]), i) for i in range(9000)
    ]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "trip_id STRING, line_no BIGINT").repartition(8)
    first = {}
    for key, n in rows:
        first[key] = min(n, first.get(key, n))
    by_window = dedup.first_occurrence(df, "trip_id", ["line_no"]).collect()
    by_minimum = dedup.first_by_minimum(df, "trip_id", "line_no").collect()
    repeated = dedup.repeated_keys(df, "trip_id", "line_no").collect()
    assert sorted(map(tuple, by_window)) == sorted(first.items())
    assert sorted(map(tuple, by_minimum)) == sorted(first.items())
    often = {key for key, n in rows if n != first[key]}
    assert dict(map(tuple, repeated)) == {key: first[key] for key in often}


def test_clean_typed(spark, stations):
    good = ("A", datetime(2026, 1, 1), "S1", "S2", 5.0, 1.0, "annuel")

    def changed(**changes):
        return tuple(changes.get(n, v) for n, v in zip(TRIP_FIELDS, good))

    rows = [
        changed(duration=0.0),  # same id, dropped before ids are compared
        good,
        changed(destination="S3"),
        *(changed(trip_id="N", **{n: None}) for n in TRIP_FIELDS[1:]),
        changed(trip_id=None),
        changed(trip_id="B", duration=float("nan")),
        changed(trip_id="B", distance=float("inf")),
        changed(trip_id="B", distance=-1.0),
        changed(trip_id="B", origin="S2"),
        changed(trip_id="B", origin="S9"),
        changed(trip_id="B", destination="S9"),
        changed(trip_id="B", kind="x"),
        changed(trip_id="B", ts=datetime(2026, 4, 1)),
        changed(trip_id="C", ts=datetime(2026, 3, 31, 23, 59, 59)),
    ]
    df = spark.createDataFrame(
        [(*row, i) for i, row in enumerate(rows)],
        "trip_id STRING, ts TIMESTAMP_NTZ, origin STRING, destination STRING, "
        "duration DOUBLE, distance DOUBLE, kind STRING, row_no INT",
    )
    clean = quality.clean_typed(df, stations, SPEC, ["row_no"])
    got = sorted(
        (r["trip_id"], r["destination"], r["month"]) for r in clean.collect()
    )
    assert got == [("A", "S2", "2026-01"), ("C", "S2", "2026-03")]
