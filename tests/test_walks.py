"""Ranks, paths and strong components against plain Python on random graphs."""

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.errors import PySparkException

from odflow.operators import walks


def graph(spark, pairs, n):
    vertices = spark.createDataFrame([(i,) for i in range(n)], "station_id INT")
    arcs = spark.createDataFrame(pairs, "src INT, dst INT, weight BIGINT")
    return vertices, arcs


def random_arcs(seed, n, m, top=9):
    rng = random.Random(seed)
    return [(rng.randrange(n), rng.randrange(n), rng.randint(1, top)) for _ in range(m)]


def plain_ranks(pairs, n, rounds, d=0.85):
    out = [0.0] * n
    for s, _, w in pairs:
        out[s] += w
    ranks = [1 / n] * n
    for _ in range(rounds):
        new = [(1 - d) / n + d * sum(r for r, o in zip(ranks, out) if not o) / n] * n
        for s, t, w in pairs:
            new[t] += d * ranks[s] * w / out[s]
        ranks = new
    return ranks


def test_pagerank(spark):
    # A hub that most arcs enter, vertices without arcs, repeated arcs, dead ends.
    pairs = random_arcs(1, 30, 60) + [(i, 3, 2) for i in range(25)] * 2
    vertices, arcs = graph(spark, pairs, 34)
    got = dict(map(tuple, walks.pagerank(vertices, arcs, tolerance=0, max_rounds=7).collect()))
    wanted = plain_ranks(pairs, 34, 7)
    assert all(math.isclose(got[i], wanted[i], rel_tol=1e-12) for i in range(34))
    settled = dict(map(tuple, walks.pagerank(vertices, arcs, tolerance=1e-7).collect()))
    assert math.isclose(sum(settled.values()), 1)
    assert all(abs(settled[i] - x) < 1e-6 for i, x in enumerate(plain_ranks(pairs, 34, 200)))


def test_pagerank_of_odd_graphs(spark):
    vertices, arcs = graph(spark, [(0, 9, 1), (9, 0, 1), (1, 0, 0), (1, 2, None)], 3)
    assert {r["rank"] for r in walks.pagerank(vertices, arcs).collect()} == {1 / 3}
    assert walks.pagerank(vertices.limit(0), arcs).collect() == []
    none = arcs.limit(0)
    assert len(walks.pagerank(vertices, none).collect()) == 3


def plain_paths(pairs, sources):
    out = {}
    for s in sources:
        best = {s: (0.0, 0)}
        for _ in range(200):
            for a, b, w in pairs:
                if a in best and (best[a][0] + w, best[a][1] + 1) < best.get(b, (math.inf, 0)):
                    best[b] = (best[a][0] + w, best[a][1] + 1)
        out |= {(s, v): c for v, c in best.items()}
    return out


def test_shortest_paths(spark):
    pairs = random_arcs(4, 40, 90) + [(i, i + 1, 1) for i in range(40, 60)] + [(5, 5, 1), (1, 2, 0)]
    arcs = spark.createDataFrame([(a, b, float(w)) for a, b, w in pairs], "src INT, dst INT, cost DOUBLE")
    got = {(r["source"], r["station_id"]): (r["cost"], r["n_arcs"]) for r in walks.shortest_paths(arcs).collect()}
    assert got == plain_paths(pairs, {p[0] for p in pairs})
    few = spark.createDataFrame([(40,), (999,), (None,), (40,)], "station_id INT")
    got = {(r[0], r[1]): (r[2], r[3]) for r in walks.shortest_paths(arcs, few).collect()}
    assert got == plain_paths(pairs, [40, 999])
    assert walks.shortest_paths(arcs.limit(0)).collect() == []
    with pytest.raises(PySparkException):
        walks.shortest_paths(arcs.withColumn("cost", F.col("cost") - 5)).collect()


def plain_components(pairs, n):
    reach = [{i} for i in range(n)]
    for _ in range(n):
        for a, b in pairs:
            reach[a] |= reach[b]
    return {i: min(j for j in range(n) if j in reach[i] and i in reach[j]) for i in range(n)}


@pytest.mark.parametrize("seed, n, m", [(1, 40, 45), (2, 40, 70), (3, 25, 120), (4, 30, 0)])
def test_strong_components(spark, seed, n, m):
    pairs = random_arcs(seed, n, m)
    vertices, arcs = graph(spark, pairs, n)
    got = dict(map(tuple, walks.strong_components(vertices, arcs).collect()))
    assert got == plain_components([p[:2] for p in pairs], n)


def test_strong_components_of_a_long_cycle(spark):
    """A cycle of 100 vertices with a tail at either end, and an arc to nowhere."""
    order = list(range(140))
    random.Random(6).shuffle(order)
    chain = [(order[i], order[i + 1], 1) for i in range(139)] + [(order[119], order[20], 1), (order[0], 500, 1)]
    vertices, arcs = graph(spark, chain, 140)
    got = dict(map(tuple, walks.strong_components(vertices, arcs).collect()))
    cycle = set(order[20:120])
    assert got == {v: min(cycle) if v in cycle else v for v in order}
