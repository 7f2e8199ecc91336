"""As-of join, sessions and interval joins against plain Python, with busy keys."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from odflow.operators import asof, intervals, sessions

START = dt.datetime(2024, 1, 1)


@pytest.fixture(autouse=True)
def many_slices(spark):
    """Small tables would be one slice."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, False)
    yield
    spark.conf.unset(name)


def at(minutes):
    return None if minutes is None else START + dt.timedelta(minutes=minutes)


def two_tables(spark, n, busy, seed=3):
    rng = random.Random(seed)

    def key():
        return 1 if rng.random() < busy else rng.choice([None, 2, 3, 4, 5, 6])

    def when():
        return None if rng.random() < 0.03 else rng.randrange(n)

    left = [(i, key(), when()) for i in range(n)]
    right = [(i, key(), when()) for i in range(n // 2)]
    schema = "{0}id INT, {0}key INT, {0}t TIMESTAMP_NTZ"
    frames = [
        spark.createDataFrame([(i, k, at(m)) for i, k, m in side], schema.format(name))
        for side, name in ((left, "l"), (right, "r"))
    ]
    return left, right, *frames


@pytest.mark.parametrize("busy", [0.1, 0.6])
@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("equal", [True, False])
def test_as_of_join(spark, busy, direction, equal):
    left, right, left_df, right_df = two_tables(spark, 600, busy)
    wanted = []
    for i, k, t in left:
        best = None
        for j, k2, t2 in right:
            if None in (k, t, t2) or k != k2 or (t == t2 and not equal):
                continue
            if direction == "backward" and t2 <= t:
                best = max(best or (t2, j), (t2, j))
            elif direction == "forward" and t2 >= t:
                best = min(best or (t2, j), (t2, j))
        wanted.append((i, k, at(t), best and best[1], best and at(best[0])))
    joined = asof.as_of_join(
        left_df, right_df, [("lkey", "rkey")], "lt", "rt", {"match": "rid", "when": "rt"},
        ["rid"], direction, equal,
    )
    got = joined.collect()
    assert sorted(map(tuple, got)) == sorted(wanted)


def test_as_of_join_within(spark):
    left, right, left_df, right_df = two_tables(spark, 300, 0.5)
    args = ([("lkey", "rkey")], "lt", "rt", {"when": "rt"}, ["rid"])
    free = {r["lid"]: r for r in asof.as_of_join(left_df, right_df, *args).collect()}
    limit = F.expr("INTERVAL 3 MINUTES")
    near = asof.as_of_join(left_df, right_df, *args, within=limit).collect()
    for r in near:
        found = free[r["lid"]]
        close = found["when"] and found["lt"] - found["when"] <= dt.timedelta(minutes=3)
        assert r["when"] == (found["when"] if close else None)
    assert {r["when"] is None for r in near} == {True, False}


def test_as_of_join_of_empty_tables(spark):
    _, _, left, right = two_tables(spark, 20, 0.5)
    args = ([("lkey", "rkey")], "lt", "rt", {"match": "rid"}, ["rid"])
    assert asof.as_of_join(left.limit(0), right, *args).collect() == []
    alone = asof.as_of_join(left, right.limit(0), *args).collect()
    assert len(alone) == 20 and all(r["match"] is None for r in alone)
    with pytest.raises(ValueError):
        asof.as_of_join(left, right, [("lkey", "rkey")], "lt", "rt", {"lid": "rid"}, ["rid"])


def test_as_of_join_splits_a_busy_key(spark):
    """The right row that all of a busy key's events refer to lies many slices back."""
    left = spark.range(4000).select(
        F.col("id").alias("lid"), F.lit(1).alias("lkey"), (F.col("id") + 10).alias("lt")
    )
    right = spark.createDataFrame([(7, 1, 5), (8, 1, 4005)], "rid INT, rkey INT, rt BIGINT")
    joined = asof.as_of_join(
        left, right, [("lkey", "rkey")], "lt", "rt", {"match": "rid"}, ["rid"]
    ).collect()
    assert all(r["match"] == (8 if r["lt"] >= 4005 else 7) for r in joined)
    rows = asof.sliced(left, [F.asc("lkey"), F.asc("lt")], "test")
    assert rows.select(asof.SLICE).distinct().count() > 1


@pytest.mark.parametrize("busy", [0.0, 0.7, 1.0])
def test_sessions(spark, busy):
    rng = random.Random(8)
    events = [
        (1 if rng.random() < busy else rng.choice([None, 2, 3]), rng.randrange(9000), rng.randrange(9))
        for _ in range(1500)
    ]
    events += [(2, None, 1), (1, 8, 1), (1, 8, 1)]
    df = spark.createDataFrame([(k, at(m), v) for k, m, v in events], "k INT, t TIMESTAMP_NTZ, v INT")
    wanted = []
    known = [e for e in events if e[1] is not None]
    for k in {e[0] for e in known}:
        own = sorted((m, v) for key, m, v in known if key == k)
        runs = [[own[0]]]
        for before, now in itertools.pairwise(own):
            if now[0] - before[0] < 20:
                runs[-1].append(now)
            else:
                runs.append([now])
        for run in runs:
            values = [v for _, v in run]
            wanted.append((k, at(run[0][0]), at(run[-1][0]), len(run), sum(values), max(values)))
    measures = {"total": ("sum", F.col("v")), "most": ("max", F.col("v"))}
    got = sessions.sessions(df, ["k"], "t", "20 minutes", measures)
    assert got.columns == ["k", "session_start", "session_end", "n_rows", "total", "most"]
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(wanted, key=key)


def test_sessions_over_many_slices(spark):
    """One session that no slice holds whole, and no rows at all."""
    df = spark.range(5000).select(F.lit("a").alias("k"), F.timestamp_seconds("id").alias("t"))
    got = sessions.sessions(df, ["k"], "t", "2 seconds").collect()
    assert [(r["n_rows"], (r["session_end"] - r["session_start"]).seconds) for r in got] == [(5000, 4999)]
    apart = sessions.sessions(df, ["k"], "t", "1 second")
    assert apart.count() == 5000
    assert sessions.sessions(df.limit(0), ["k"], "t", "1 second").collect() == []


def spans(seed, n, busy):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        start = rng.choice([None, *[rng.randrange(-500, 2000)] * 30])
        length = rng.choice([0, 1, 2, 3, 7, 8, 9, 64, 65, 300, 2000, -4])
        key = "a" if rng.random() < busy else rng.choice(["b", "c", None])
        out.append((i, key, start, None if start is None else start + length))
    return out


def meet(x, y):
    if None in x or None in y or x[2] >= x[3] or y[2] >= y[3]:
        return False
    return x[1] == y[1] and x[2] < y[3] and y[2] < x[3]


@pytest.mark.parametrize("busy", [0.2, 0.8])
def test_overlap_joins(spark, busy):
    a, b = spans(1, 160, busy), spans(2, 140, busy)
    schema = "id INT, k STRING, s BIGINT, e BIGINT"
    left, right = (spark.createDataFrame(side, schema) for side in (a, b))
    got = intervals.overlap_join(left, right, [("k", "k")], ("s", "e"), ("s", "e"))
    pairs = sorted((r["left"]["id"], r["right"]["id"]) for r in got.collect())
    assert pairs == sorted((x[0], y[0]) for x in a for y in b if meet(x, y))
    own = intervals.overlaps(left, ["k"], ("s", "e"), ["id"]).collect()
    wanted = {frozenset((x[0], y[0])) for x, y in itertools.combinations(a, 2) if meet(x, y)}
    found = [frozenset((r["left"]["id"], r["right"]["id"])) for r in own]
    assert len(found) == len(set(found)) and set(found) == wanted


def test_overlaps_of_dates_and_times(spark):
    df = spark.createDataFrame(
        [(1, at(0), at(60)), (2, at(59), at(61)), (3, at(60), at(70)), (4, at(-1), at(0))],
        "id INT, s TIMESTAMP_NTZ, e TIMESTAMP_NTZ",
    ).withColumn("k", F.lit(0))
    got = intervals.overlaps(df, ["k"], ("s", "e"), ["id"]).collect()
    assert {(r["left"]["id"], r["right"]["id"]) for r in got} == {(1, 2), (2, 3)}
    days = df.select("id", "k", F.to_date("s").alias("s"), F.date_add("e", 1).alias("e"))
    assert intervals.overlaps(days, ["k"], ("s", "e"), ["id"]).count() == 6


def test_compared_rows_follow_the_matches(spark):
    """Short intervals of one key, and one that spans them all: no bin compares all pairs."""
    n = 3000
    short = spark.range(n).select(
        F.col("id"), F.lit("a").alias("k"), (F.col("id") * 10).alias("s"), (F.col("id") * 10 + 12).alias("e")
    )
    long = spark.createDataFrame([(n, "a", 0, n * 10)], short.schema)
    rows = short.unionByName(long)
    assert intervals.overlaps(rows, ["k"], ("s", "e"), ["id"]).count() == (n - 1) + n
    bounded = intervals._bounded(rows, ["k"], "s", "e", "row")
    compared = intervals._starts_inside(bounded, bounded, 1, F.lit(True))
    plan = compared._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
