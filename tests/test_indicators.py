"""Indicators, profile and graph against plain Python on random trips."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from odflow.operators import compare, graph, indicators, profile, rolling
from odflow.spec import TRIP_SCHEMA

STATIONS = [(f"S{i:02d}", f"Station {i}", i % 3) for i in range(12)]
ZONE = {s: z for s, _, z in STATIONS}
NAME = {s: n for s, n, _ in STATIONS}


def make_trips():
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        # A third of all trips start at one station; S10 only receives, S11 only
        # sends, so neither may appear where both directions are needed.
        origin = "S03" if rng.random() < 0.34 else f"S{rng.choice([*range(10), 11]):02d}"
        destination = f"S{rng.randrange(11):02d}"
        if origin == destination:
            continue
        rows.append(
            (
                f"T{i}",
                datetime(2026, 1 + i % 3, 1),
                origin,
                destination,
                float(rng.randrange(1, 60)),
                rng.randrange(1, 90) / 4,
                "annuel",
            )
        )
    return rows


ROWS = make_trips()
PAIRS = Counter((r[2], r[3]) for r in ROWS)
OUT = Counter(r[2] for r in ROWS)
IN = Counter(r[3] for r in ROWS)
BOTH = sorted(set(OUT) & set(IN))


@pytest.fixture(scope="module")
def trips(spark):
    return spark.createDataFrame(ROWS, TRIP_SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def stations(spark):
    return spark.createDataFrame(STATIONS, "station_id STRING, name STRING, zone INT")


@pytest.fixture(scope="module")
def degrees(trips, stations):
    return graph.degrees(graph.vertices(stations), graph.arcs(trips))


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_flows(trips, stations):
    expected = [(s, NAME[s], ZONE[s], OUT[s], IN[s]) for s in BOTH]
    flows = indicators.flows_by_station(trips, stations)
    assert "S10" not in BOTH and "S11" not in BOTH
    assert rows(flows) == expected
    assert rows(indicators.flow_totals(flows)) == [
        (sum(OUT[s] for s in BOTH), sum(IN[s] for s in BOTH))
    ]


def test_flow_extremes_keep_ties(spark):
    flows = spark.createDataFrame(
        [("a", 5, 1), ("b", 5, 2), ("c", 7, 2)],
        "station_id STRING, n_departures BIGINT, n_arrivals BIGINT",
    )
    assert rows(indicators.flow_extremes(flows)) == [
        ("arrivals", "max", 2, "b"),
        ("arrivals", "max", 2, "c"),
        ("arrivals", "min", 1, "a"),
        ("departures", "max", 7, "c"),
        ("departures", "min", 5, "a"),
        ("departures", "min", 5, "b"),
    ]


def test_mean_by_zone_divides_once(trips, stations):
    total, n = Counter(), Counter()
    for r in ROWS:
        total[ZONE[r[2]]] += r[4]
        n[ZONE[r[2]]] += 1
    expected = [(z, total[z], n[z], round(total[z] / n[z], 2)) for z in sorted(n)]
    assert rows(indicators.mean_by_zone(trips, stations)) == expected
    grouped = indicators.mean_by_zone(trips, stations, indicators.partial_sums_grouped)
    assert rows(grouped) == expected


def test_sum_and_count_variants(trips):
    combined = indicators.sum_and_count(trips)
    saved = trips.sparkSession.conf.get("spark.sql.shuffle.partitions")
    for n in (1, 7, 64):
        trips.sparkSession.conf.set("spark.sql.shuffle.partitions", n)
        grouped = indicators.sum_and_count_grouped(trips)
        assert compare.difference(combined, grouped).first()["identical"]
    trips.sparkSession.conf.set("spark.sql.shuffle.partitions", saved)
    assert {r["origin"]: r["n_trips"] for r in combined.collect()} == OUT


def test_fractional_durations_sum_alike_however_partitioned(trips, stations):
    """Sums of doubles would differ in the last digits; totals of decimals do not."""
    tenths = trips.withColumn("duration", F.col("duration") * 0.1 + 0.7)
    first = indicators.mean_by_zone(tenths.repartition(1), stations)
    for n in (7, 64):
        again = tenths.repartition(n, "trip_id")
        for sums in (indicators.partial_sums, indicators.partial_sums_grouped):
            other = indicators.mean_by_zone(again, stations, sums)
            assert compare.difference(first, other).first()["identical"]


def test_huge_durations_are_summed_too(spark, stations):
    rows_ = [("S00", "T1", 1e300), ("S00", "T2", 2.5), ("S01", "T3", 0.25)]
    trips = spark.createDataFrame(rows_, "origin STRING, trip_id STRING, duration DOUBLE")
    for f in (indicators.sum_and_count, indicators.sum_and_count_grouped):
        assert sorted(rows(f(trips))) == [("S00", 1e300, 2), ("S01", 0.25, 1)]


def test_top_pairs(trips, stations):
    best = sorted(PAIRS.items(), key=lambda kv: (-kv[1], kv[0]))[:10]
    assert rows(indicators.top_pairs(trips, stations)) == [
        (i, o, NAME[o], d, NAME[d], n) for i, ((o, d), n) in enumerate(best, 1)
    ]


def test_departures_by_prefix(trips):
    got = dict(rows(indicators.departures(trips, "S0")))
    assert got == {s: n for s, n in OUT.items() if s.startswith("S0")}
    assert dict(rows(indicators.departures(trips))) == OUT


def test_speed_range(trips):
    speeds = [r[5] * 60 / r[4] for r in ROWS]
    assert rows(indicators.speed_range(trips)) == [(min(speeds), max(speeds))]


def test_degrees(degrees):
    expected = []
    for s in BOTH:
        into = [n for (_, d), n in PAIRS.items() if d == s]
        out = [n for (o, _), n in PAIRS.items() if o == s]
        expected.append(
            (s, NAME[s], len(into), len(out), sum(into), sum(out), sum(into + out))
        )
    assert rows(degrees) == expected


def test_graph_reports(trips, stations, degrees):
    vertices, arcs = graph.vertices(stations), graph.arcs(trips)
    assert rows(graph.summary(vertices, arcs)) == [
        (12, len(PAIRS), 12 * 11, len(ROWS))
    ]
    assert rows(graph.sorted_arcs(arcs)) == sorted((*p, n) for p, n in PAIRS.items())
    best = sorted(PAIRS.items(), key=lambda kv: (-kv[1], kv[0]))[:5]
    assert rows(graph.heaviest_arcs(arcs)) == [(*p, n) for p, n in best]
    assert not graph.completeness(vertices, degrees).first()["complete"]


def test_complete_graph(spark):
    vertices = spark.createDataFrame(
        [(s, s) for s in "abc"], "station_id STRING, name STRING"
    )
    arcs = [(s, d, 2) for s in "abc" for d in "abc" if s != d]
    schema = "src STRING, dst STRING, weight BIGINT"
    for given, complete in ((arcs, True), (arcs[1:], False), ([], True)):
        degrees = graph.degrees(vertices, spark.createDataFrame(given, schema))
        assert graph.completeness(vertices, degrees).first()["complete"] is complete


def test_top_vertices_break_ties_by_degree_then_id(spark):
    degrees = spark.createDataFrame(
        [
            ("d", "D", 1, 1, 5, 5, 10),
            ("c", "C", 2, 2, 5, 5, 10),
            ("b", "B", 1, 1, 5, 5, 10),
            ("a", "A", 9, 9, 1, 1, 2),
            ("e", "E", 1, 1, 9, 2, 11),
        ],
        "station_id STRING, name STRING, in_degree BIGINT, out_degree BIGINT, "
        "in_weight BIGINT, out_weight BIGINT, total_weight BIGINT",
    )
    top = graph.top_vertices(degrees, 4)
    assert [(r["rank"], r["station_id"]) for r in top.collect()] == [
        (1, "e"),
        (2, "c"),
        (3, "b"),
        (4, "d"),
    ]


def test_difference_counts_multiplicity(spark):
    def bag(*values):
        return spark.createDataFrame([(v,) for v in values], "v STRING")

    left, right = bag("a", "a", "b", None), bag("a", "b", "b", "c", None)
    assert rows(compare.difference(left, right)) == [(1, 2, False)]
    assert rows(compare.difference(left, left)) == [(0, 0, True)]
    assert rows(compare.difference(left.limit(0), left.limit(0))) == [(0, 0, True)]


def test_profile(spark, stations):
    raw = [
        "T1,2026-02-01 10:00:00,S01,S02,15,3.2,annuel",
        "T1,2026-2-1 9:00:00,S01,S01,nan,inf,mensuel",
        "T2,x,S99,S02,-inf,0,annuel",
        "T3,2026-02-01 10:00:00,S01, ,abc,1_0,annuel",
        "T4,2026-02-01",
        "",
    ]
    lines = spark.createDataFrame(
        list(enumerate(raw, 1)), "line_no BIGINT, raw STRING"
    )
    complete = profile.complete_lines(lines)
    marked = profile.mark_anomalies(complete, stations)
    assert dict(rows(profile.field_counts(lines))) == {7: 4, 2: 1, 1: 1}
    assert dict(rows(profile.value_counts(complete))) == {"annuel": 3, "mensuel": 1}
    assert dict(rows(profile.blank_counts(lines))) == {
        "trip_id": 1,
        "ts": 1,
        "origin": 2,
        "destination": 3,
        "duration": 2,
        "distance": 2,
        "kind": 2,
    }
    wide = profile.header_columns("id,when ,from,to,min,km,kind,, id,id")
    assert wide == ["id", "when", "from", "to", "min", "km", "kind", "#8", "id#9", "id#10"]
    assert rows(profile.blank_counts(lines, wide))[6:] == [("kind", 2), ("#8", 6), ("id#9", 6), ("id#10", 6)]
    assert rows(profile.blank_counts(lines, ["id"])) == [("id", 1)]
    assert rows(profile.blank_counts(lines.limit(0), ["id", "when"])) == [("id", 0), ("when", 0)]
    assert dict(rows(profile.anomaly_counts(marked))) == {
        "unknown_station": 2,
        "loop": 1,
        "bad_duration": 2,
        "bad_distance": 1,
        "bad_date": 1,
    }
    sample = profile.anomaly_samples(marked, {"unknown_station": 1, "bad_duration": 3})
    assert sorted((r["anomaly"], r["line_no"]) for r in sample.collect()) == [
        ("bad_duration", 3),
        ("bad_duration", 4),
        ("unknown_station", 3),
    ]
    assert rows(profile.date_range(complete)) == [
        ("2026-02-01 10:00:00", "2026-2-1 9:00:00")
    ]
    assert rows(profile.repeated_ids(lines)) == [("T1", 2)]
    assert [r["line_no"] for r in profile.tail(lines, 2).collect()] == [5, 6]


def test_subtotals_of_all_levels(trips, stations):
    got = indicators.subtotals(trips.withColumn("month", F.lit("2024-01")), stations)
    levels = Counter(r["level"] for r in got.collect())
    kinds, zones = len({r[6] for r in ROWS}), len(set(ZONE.values()))
    assert levels[7] == levels[3] == 1 and levels[5] <= zones and levels[6] == kinds
    whole = got.filter("level = 7").first()
    assert whole["n_trips"] == len(ROWS) and whole["total_duration"] == sum(r[4] for r in ROWS)


def test_rolling_flows(spark):
    rng = random.Random(9)
    days = [rng.choice([None, *range(40)]) for _ in range(300)]
    start = datetime(2024, 2, 20)
    rows_ = [(rng.choice(["A", "B", None]), None if d is None else start + timedelta(days=d, hours=7)) for d in days]
    trips = spark.createDataFrame(rows_, "origin STRING, ts TIMESTAMP_NTZ")
    count = Counter((o, t.date()) for o, t in rows_ if o and t)
    for n in (1, 2, 7):
        wanted = {
            (o, d, k, sum(count[o, d - timedelta(days=i)] for i in range(n)), k - count[o, d - timedelta(days=1)])
            for (o, d), k in list(count.items())
        }
        got = [tuple(r) for r in rolling.rolling_departures(trips, n).collect()]
        assert len(got) == len(wanted) and set(got) == wanted
        swapped = trips.withColumnRenamed("origin", "destination")
        assert {tuple(r) for r in rolling.rolling_arrivals(swapped, n).collect()} == wanted
