"""Sketches that merge, against exact counts and ranks."""

import random

import pytest
from pyspark.sql import functions as F

from odflow.operators import sketches
from odflow.sources.scratch import materialize

SHARES = [0.0, 0.1, 0.5, 0.9, 0.99, 1.0]


@pytest.fixture(scope="module")
def rows(spark):
    """Month 0 has most rows; ids are shared by neighbouring months."""
    draw = random.Random(5)
    data = [
        (0 if draw.random() < 0.6 else draw.randrange(1, 12), draw.randrange(9000), draw.paretovariate(1.2))
        for _ in range(60_000)
    ]
    data += [(3, None, None), (4, 7, float("nan")), (None, 1, 2.0)]
    return spark.createDataFrame(data, "month INT, id INT, x DOUBLE").repartition(9)


def state_of(rows):
    return sketches.sketch_state(rows, ["month"], {"ids": "id"}, {"xs": F.col("x")})


def off(values, share, found):
    """Distance of a share from the exact ranks of a value."""
    below = sum(v < found for v in values) / len(values)
    up_to = sum(v <= found for v in values) / len(values)
    return max(below - share, share - up_to, 0.0)


def test_merged_months_against_exact_values(spark, rows):
    # Two files of months, as if the last months had come later.
    first = materialize(state_of(rows.filter("month < 8 or month is null")), "state")
    later = materialize(state_of(rows.filter("month >= 8")), "state")
    state = first.unionByName(later)
    quarter = (F.col("month") / 3).cast("int").alias("quarter")
    merged = sketches.merge_states(state, [quarter], ["ids"], ["xs"])
    found = merged.select(
        "quarter",
        "n_rows",
        sketches.distinct_estimate("ids").alias("ids"),
        sketches.quantile_estimates("xs", SHARES).alias("xs"),
    ).collect()
    exact = {}
    for r in rows.collect():
        exact.setdefault(None if r["month"] is None else r["month"] // 3, []).append(r)
    assert {r["quarter"] for r in found} == set(exact)
    for r in found:
        of = exact[r["quarter"]]
        ids = len({x["id"] for x in of if x["id"] is not None})
        values = [x["x"] for x in of if x["x"] is not None and x["x"] == x["x"]]
        assert r["n_rows"] == len(of)
        assert abs(r["ids"] - ids) <= 0.04 * ids
        assert all(off(values, s, v) <= 0.02 for s, v in zip(SHARES, r["xs"], strict=True))
        assert (r["xs"][0], r["xs"][-1]) == (min(values), max(values))


def test_merging_in_steps_and_all_at_once(rows):
    state = materialize(state_of(rows), "state")
    half = (F.col("month") % 2).alias("half")
    halves = sketches.merge_states(state, [half], ["ids"], ["xs"])
    both = sketches.merge_states(halves, [], ["ids"], ["xs"])
    once = sketches.merge_states(state, [], ["ids"], ["xs"])
    a, b = (
        m.select("n_rows", sketches.distinct_estimate("ids").alias("ids"), F.kll_sketch_get_n_double("xs")).first()
        for m in (both, once)
    )
    assert a == b


def test_plan_of_a_merge_reads_only_states(rows):
    state = materialize(state_of(rows), "state")
    plan = sketches.merge_states(state, [], ["ids"], ["xs"])._jdf.queryExecution().toString()
    assert "state-" in plan and "LogicalRDD" not in plan


def test_empty_and_odd_input(spark, rows):
    assert state_of(rows.filter("false")).collect() == []
    nulls = spark.createDataFrame([(1, None, None)], "month INT, id INT, x DOUBLE")
    row = state_of(nulls).select(
        "n_rows", sketches.distinct_estimate("ids"), sketches.quantile_estimates("xs", [0.5])
    ).first()
    assert tuple(row) == (1, 0, None)
    with pytest.raises(ValueError):
        sketches.sketch_state(rows, ["month"], {"month": "id"}, {})
    with pytest.raises(ValueError):
        sketches.sketch_state(rows, ["month"], {"x": "id"}, {"x": "x"})
    with pytest.raises(ValueError):
        sketches.quantile_estimates("xs", [1.5])
