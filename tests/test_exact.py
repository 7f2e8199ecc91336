"""Sums of doubles against exact fractions, over any order and partitioning."""

import math
import random
from fractions import Fraction

import pytest

from odflow.operators import exact, indicators


def totals(df):
    rows = exact.totals(exact.partial_sums(df, ["k"], "x"), ["k"], "total").collect()
    return {r["k"]: (r["total"], r["n"]) for r in rows}


def frame(spark, groups, parts=1):
    rows = [(k, x) for k, values in groups.items() for x in values]
    random.Random(parts).shuffle(rows)
    return spark.createDataFrame(rows, "k STRING, x DOUBLE").repartition(parts)


GROUPS = {
    "tiny": [1e-10, 2e-10],
    "long": [0.1234567890123],
    "half": [1e15 + 0.5, 1e15 + 0.5, 0.25],
    "huge": [1e300, 1.0, -1e300],
    "largest": [1.7976931348623157e308, -1.7976931348623157e308, 5e-324],
    "smallest": [5e-324] * 3,
    "tenths": [0.1] * 10,
    "cancels": [1e16, 1.0, -1e16],
    "negative": [-0.1, -0.2, 0.3],
    "minus": [-1e-300, -1.0, 1.0],
    "zero": [0.0, -0.0],
    "powers": [2.0**k for k in range(-300, 300, 7)],
    "near": [math.nextafter(2.0**k, d) for k in range(-66, 67, 22) for d in (0, math.inf)],
    "null": [None, 2.5],
    "nulls": [None],
}


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_sums_are_exact(spark, parts):
    rng = random.Random(1)
    groups = dict(GROUPS)
    groups["random"] = [rng.uniform(-1, 1) * 10.0 ** rng.randint(-30, 30) for _ in range(3000)]
    got = totals(frame(spark, groups, parts))
    for k, values in groups.items():
        known = [x for x in values if x is not None]
        wanted = float(sum(map(Fraction, known))) if known else 0.0
        assert got[k] == (wanted, len(values)), k


def test_values_without_digits(spark):
    inf, nan = math.inf, math.nan
    got = totals(frame(spark, {"inf": [1.0, inf], "both": [inf, -inf], "nan": [nan, 2.0]}))
    assert got["inf"][0] == inf and math.isnan(got["both"][0]) and math.isnan(got["nan"][0])


def test_merged_levels_and_one_large_key(spark):
    rng = random.Random(2)
    rows = [("a" if rng.random() < 0.6 else rng.choice("bcd"), rng.random()) for _ in range(20_000)]
    trips = spark.createDataFrame(
        [(k, k < "c", x, i) for i, (k, x) in enumerate(rows)],
        "origin STRING, zone BOOLEAN, duration DOUBLE, trip_id INT",
    )
    wanted = {k: float(sum(Fraction(x) for o, x in rows if o == k)) for k in "abcd"}
    for sums in (indicators.sum_and_count, indicators.sum_and_count_grouped):
        assert {r["origin"]: r["total_duration"] for r in sums(trips).collect()} == wanted
    stations = trips.select(trips.origin.alias("station_id"), "zone").distinct()
    zones = indicators.mean_by_zone(trips, stations).collect()
    for zone, keys in ((True, "ab"), (False, "cd")):
        total = float(sum(Fraction(x) for o, x in rows if o in keys))
        assert next(r["total_duration"] for r in zones if r["zone"] == zone) == total
