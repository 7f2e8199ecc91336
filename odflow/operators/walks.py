"""Ranks, shortest paths and strong components of a directed graph, round by round.

Every round is a join on arcs and an aggregate, and its result is a written table, so the
lineage never grows. One row per round, such as a count of changes, reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflow.sources.scratch import materialize


def pagerank(
    vertices: DataFrame,
    arcs: DataFrame,
    damping: float = 0.85,
    tolerance: float = 1e-9,
    max_rounds: int = 100,
) -> DataFrame:
    """``(station_id, rank)``; ranks sum to 1.

    A vertex hands its rank on along its arcs in proportion to their weight; one without
    outgoing arcs hands it to all vertices alike. The rounds end when the ranks change by
    ``tolerance`` or less in sum, or after ``max_rounds``; ``tolerance=0`` makes exactly
    ``max_rounds`` unless nothing changes. Arcs with a null weight or one of 0 or less, and
    arcs that end outside ``vertices``, do not count. Without vertices there are no rows.
    """
    nodes = vertices.select("station_id").distinct()
    known = arcs.filter(F.col("weight") > 0).select("src", "dst", "weight")
    for end in ("src", "dst"):
        known = known.join(
            nodes.withColumnRenamed("station_id", end), end, "left_semi"
        )
    links = materialize(
        known.groupBy("src", "dst").agg(F.sum("weight").alias("weight")), "links"
    )
    out = links.groupBy("src").agg(F.sum("weight").alias("_out"))
    shares = links.join(materialize(out, "out-weights"), "src").select(
        "src", "dst", (F.col("weight") / F.col("_out")).alias("share")
    )
    shares = materialize(shares, "arc-shares")
    ends = shares.select(F.col("src").alias("station_id")).distinct().withColumn("_going", F.lit(True))
    nodes = nodes.join(ends, "station_id", "left").select(
        "station_id", F.coalesce("_going", F.lit(False)).alias("going")
    )
    nodes = materialize(nodes, "rank-vertices")
    n = nodes.count()
    ranks = nodes.select("station_id", "going", F.lit(1.0 / max(n, 1)).alias("rank"))
    stuck = F.coalesce(F.sum(F.when(~F.col("going"), F.col("rank"))), F.lit(0.0))
    lost = ranks.agg(stuck).first()[0]
    for _ in range(max_rounds if n else 0):
        given = (
            shares.join(ranks.select(F.col("station_id").alias("src"), "rank"), "src")
            .groupBy(F.col("dst").alias("station_id"))
            .agg(F.sum(F.col("rank") * F.col("share")).alias("_given"))
        )
        base = (1 - damping) / n + damping * lost / n
        new = base + damping * F.coalesce("_given", F.lit(0.0))
        ranks = materialize(
            ranks.join(given, "station_id", "left").select(
                "station_id", "going", new.alias("rank"), F.abs(new - F.col("rank")).alias("change")
            ),
            "ranks",
        )
        lost, change = ranks.agg(stuck, F.sum("change")).first()
        if change <= tolerance:
            break
    return ranks.select("station_id", "rank")


def shortest_paths(arcs: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """``(source, station_id, cost, n_arcs)``: the cheapest way to all that can be reached.

    ``arcs`` have ``(src, dst, cost)``; ``sources`` is a table of ``station_id``, by default every
    vertex with an outgoing arc. Of ways of equal cost the one with the fewest arcs counts.
    A source reaches itself at cost 0. Null costs count as no arc; a negative cost raises
    an error. Each round goes on only from the vertices that became cheaper in the last one,
    and the rounds end when there are none.
    """
    best_arc = arcs.filter(F.col("cost").isNotNull() & F.col("src").isNotNull() & F.col("dst").isNotNull())
    cost = F.when(F.col("cost") >= 0, F.col("cost").cast("double")).otherwise(
        F.raise_error(F.lit("a cost is negative")).cast("double")
    )
    best_arc = materialize(
        best_arc.groupBy("src", "dst").agg(F.min(cost).alias("_step")), "cheapest-arcs"
    )
    if sources is None:
        sources = best_arc.select(F.col("src").alias("station_id"))
    start = sources.filter(F.col("station_id").isNotNull()).select(
        F.col("station_id").alias("source"),
        "station_id",
        F.lit(0.0).alias("cost"),
        F.lit(0).cast("bigint").alias("n_arcs"),
    )
    known = materialize(start.distinct().withColumn("fresh", F.lit(True)), "distances")
    while not known.filter("fresh").isEmpty():
        front = known.filter("fresh").drop("fresh")
        step = (
            front.join(best_arc, front.station_id == best_arc.src)
            .groupBy("source", F.col("dst").alias("station_id"))
            .agg(
                F.min(
                    F.struct((F.col("cost") + F.col("_step")).alias("cost"), (F.col("n_arcs") + 1).alias("n_arcs"))
                ).alias("_new")
            )
        )
        old = F.struct("cost", "n_arcs")
        better = F.col("_new").isNotNull() & (F.col("cost").isNull() | (F.col("_new") < old))
        both = known.drop("fresh").join(step, ["source", "station_id"], "full")
        known = materialize(
            both.select(
                "source",
                "station_id",
                F.when(better, F.col("_new.cost")).otherwise(F.col("cost")).alias("cost"),
                F.when(better, F.col("_new.n_arcs")).otherwise(F.col("n_arcs")).alias("n_arcs"),
                better.alias("fresh"),
            ),
            "distances",
        )
    return known.drop("fresh")


def _spread(labels: DataFrame, arcs: DataFrame) -> DataFrame:
    """``(station_id, color, mark)``: the greatest mark that reaches a vertex of its color.

    Marks go along the arcs inside a color. Besides single arcs, a round follows the
    marks' own marks (pointer jumping), so a long chain takes few rounds.
    """
    now = materialize(labels.withColumn("mark", F.col("station_id")), "marks")
    while True:
        sent = arcs.join(now.select(F.col("station_id").alias("src"), "mark"), "src").groupBy(
            F.col("dst").alias("station_id")
        ).agg(F.max("mark").alias("_sent"))
        # The mark of my mark reaches me too: it reaches a vertex that reaches me.
        jump = now.select(F.col("station_id").alias("mark"), F.col("mark").alias("_far"))
        new = F.greatest("mark", F.coalesce("_sent", "mark"), F.coalesce("_far", "mark"))
        after = materialize(
            now.join(sent, "station_id", "left")
            .join(jump, "mark", "left")
            .select("station_id", "color", new.alias("mark"), (new != F.col("mark")).alias("moved")),
            "marks",
        )
        now = after.drop("moved")
        if after.filter("moved").isEmpty():
            return now


def strong_components(vertices: DataFrame, arcs: DataFrame) -> DataFrame:
    """``(station_id, component)``: vertices that reach one another; the smallest one names it.

    Vertices without an arc in or out, inside what is left, are components of their own
    and are trimmed first, so that chains and trees go in bulk. Then the greatest vertex that reaches
    each vertex is its color; among those of a color, the ones that reach the color's own
    vertex are its component, and the others go on. Arcs that end outside ``vertices``
    and loops do not count.
    """
    left = materialize(vertices.select("station_id").distinct(), "scc-vertices")
    inside = arcs.select("src", "dst").filter(F.col("src") != F.col("dst")).distinct()
    for end in ("src", "dst"):
        inside = inside.join(left.withColumnRenamed("station_id", end), end, "left_semi")
    inside = materialize(inside, "scc-arcs")
    done = []
    while True:
        left, inside, single = _trimmed(left, inside)
        done += single
        if inside.isEmpty():
            break
        labels = left.withColumn("color", F.lit(0))
        forward = _spread(labels, inside).select("station_id", F.col("mark").alias("color"))
        colored = materialize(forward, "scc-colors")
        color_of = {
            e: colored.select(F.col("station_id").alias(e), F.col("color").alias(f"_{e}"))
            for e in ("src", "dst")
        }
        same = inside.join(color_of["src"], "src").join(color_of["dst"], "dst")
        same = materialize(same.filter(F.col("_src") == F.col("_dst")).select("src", "dst"), "scc-arcs")
        back = same.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
        # Backwards, the color's own vertex is the greatest and its mark wins wherever it comes.
        found = _spread(colored, back).withColumn("_in", F.col("mark") == F.col("color"))
        found = materialize(found, "scc-found")
        done.append(found.filter("_in").select("station_id", F.col("color").alias("_name")))
        left = materialize(found.filter(~F.col("_in")).select("station_id"), "scc-vertices")
        for end in ("src", "dst"):
            same = same.join(left.withColumnRenamed("station_id", end), end, "left_semi")
        inside = materialize(same, "scc-arcs")
    members = done[0]
    for part in done[1:]:
        members = members.unionByName(part)
    members = materialize(members, "scc-members")
    names = members.groupBy("_name").agg(F.min("station_id").alias("component"))
    return members.join(names, "_name").select("station_id", "component")


def _trimmed(left: DataFrame, arcs: DataFrame) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Vertices and arcs without those that cannot lie on a cycle, and these, a few times.

    A long chain is not peeled to its end, one vertex per round; the colors take it.
    """
    single = []
    for _ in range(3):
        ends = arcs.select(F.col("src").alias("station_id")).intersect(arcs.select("dst"))
        keep = materialize(left.join(ends, "station_id", "left_semi"), "scc-vertices")
        gone = left.join(keep, "station_id", "left_anti").withColumn("_name", F.col("station_id"))
        single.append(materialize(gone, "scc-single"))
        if single[-1].isEmpty():
            break
        for end in ("src", "dst"):
            arcs = arcs.join(keep.withColumnRenamed("station_id", end), end, "left_semi")
        left, arcs = keep, materialize(arcs, "scc-arcs")
    return left, arcs, single
