"""Directed graph of stations, arcs weighted by trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def vertices(stations: DataFrame) -> DataFrame:
    """``(station_id, name)``."""
    return stations.select("station_id", "name")


def arcs(trips: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``(src, dst, weight)``: one arc per (origin, destination) with trips.

    With ``by``, such as the month, there is one graph per value of those columns.
    """
    return trips.groupBy(
        *by, F.col("origin").alias("src"), F.col("destination").alias("dst")
    ).agg(F.count("*").alias("weight"))


def degrees(
    vertices: DataFrame, arcs: DataFrame, by: tuple[str, ...] = ()
) -> DataFrame:
    """In and out degree of every vertex, plain (neighbours) and weighted (trips).

    Both ends of an arc go through one aggregate. A vertex without incoming or
    without outgoing arcs is left out.
    """
    ends = arcs.select(
        *by,
        F.inline(
            F.array(
                F.struct(
                    F.col("src").alias("station_id"),
                    F.lit(0).alias("i"),
                    F.lit(1).alias("o"),
                    F.lit(0).cast("bigint").alias("wi"),
                    F.col("weight").alias("wo"),
                ),
                F.struct(
                    F.col("dst").alias("station_id"),
                    F.lit(1).alias("i"),
                    F.lit(0).alias("o"),
                    F.col("weight").alias("wi"),
                    F.lit(0).cast("bigint").alias("wo"),
                ),
            )
        ),
    )
    per_vertex = (
        ends.groupBy(*by, "station_id")
        .agg(
            F.sum("i").alias("in_degree"),
            F.sum("o").alias("out_degree"),
            F.sum("wi").alias("in_weight"),
            F.sum("wo").alias("out_weight"),
        )
        .filter((F.col("in_degree") > 0) & (F.col("out_degree") > 0))
        .withColumn("total_weight", F.col("in_weight") + F.col("out_weight"))
    )
    return vertices.join(per_vertex, "station_id").orderBy(*by, "station_id")


def summary(vertices: DataFrame, arcs: DataFrame) -> DataFrame:
    """One row: vertices, arcs, most arcs possible without loops, total weight."""
    n = vertices.agg(F.count("*")).scalar()
    return (
        arcs.agg(
            F.count("*").alias("n_arcs"),
            F.coalesce(F.sum("weight"), F.lit(0)).alias("total_weight"),
        )
        .withColumn("n_vertices", n)
        .select(
            "n_vertices",
            "n_arcs",
            (F.col("n_vertices") * (F.col("n_vertices") - 1)).alias("max_arcs"),
            "total_weight",
        )
    )


def completeness(vertices: DataFrame, degrees: DataFrame) -> DataFrame:
    """One row: does every vertex have all others as neighbours, both ways?"""
    others = vertices.agg(F.count("*") - 1).scalar()
    full = (F.col("in_degree") == others) & (F.col("out_degree") == others)
    return degrees.agg(
        F.coalesce(F.bool_and(full), F.lit(True)).alias("complete")
    )


def top_vertices(degrees: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` best connected vertices with rank.

    Order: total weight, then plain degree, then id.
    """
    order = [
        F.desc("total_weight"),
        (F.col("in_degree") + F.col("out_degree")).desc(),
        F.col("station_id"),
    ]
    top = degrees.orderBy(*order).limit(n)
    return top.select(
        F.row_number().over(Window.orderBy(*order)).alias("rank"),
        "station_id",
        "name",
        "total_weight",
        "in_weight",
        "out_weight",
    ).orderBy("rank")


def top_vertices_by(degrees: DataFrame, by: tuple[str, ...], n: int = 5) -> DataFrame:
    """:func:`top_vertices` of each graph; a limit per graph comes before the shuffle."""
    order = [
        F.desc("total_weight"),
        (F.col("in_degree") + F.col("out_degree")).desc(),
        F.col("station_id"),
    ]
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return (
        degrees.withColumn("rank", rank)
        .filter(F.col("rank") <= n)
        .select(
            *by, "rank", "station_id", "name", "total_weight", "in_weight", "out_weight"
        )
    )


def heaviest_arcs(arcs: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` arcs with most trips; ties by ids."""
    return arcs.orderBy(F.desc("weight"), "src", "dst").limit(n)


def sorted_arcs(arcs: DataFrame) -> DataFrame:
    """All arcs by source and destination."""
    return arcs.select("src", "dst", "weight").orderBy("src", "dst")
