"""First occurrence per key, and the keys that repeat; safe for frequent keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_occurrence(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of every ``key`` in ``order``.

    Spark turns "row number = 1" into a group limit before the shuffle: each map
    task sends at most one row per key, however frequent the key is.
    """
    first = Window.partitionBy(key).orderBy(*order)
    return (
        df.withColumn("_row", F.row_number().over(first))
        .filter(F.col("_row") == 1)
        .drop("_row")
    )


def repeated_keys(df: DataFrame, key: str, order: str) -> DataFrame:
    """``(key, first_seen, n)`` for the keys with several rows.

    Only the key and the order column are shuffled, after a partial aggregate in
    each map task. Write the result where it is joined to all rows: the join is then
    planned by its true size, broadcast when repeats are few, as they usually are.
    """
    return (
        df.groupBy(key)
        .agg(F.min(order).alias("first_seen"), F.count("*").alias("n"))
        .filter(F.col("n") > 1)
    )


def first_by_minimum(df: DataFrame, key: str, order: str) -> DataFrame:
    """:func:`first_occurrence` as minimum per key and join; a cross-check.

    Grouping by the hash as well leaves the minima with a partitioning of their
    own, so that the join shuffles both sides and can split a frequent key.
    """
    minimum = (
        df.groupBy(key, F.xxhash64(key).alias("_hash"))
        .agg(F.min(order).alias("_first"))
        .drop("_hash")
    )
    return (
        df.join(minimum, key)
        .filter(F.col(order) == F.col("_first"))
        .select(*df.columns)
    )
