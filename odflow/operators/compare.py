"""Equality of two results as bags of rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: rows only on the left, only on the right, and ``identical``.

    Rows count with their multiplicity, as in ``EXCEPT ALL`` both ways, but both
    directions come from one aggregate that combines before its shuffle.
    """
    signed = left.withColumn("_sign", F.lit(1)).unionByName(
        right.withColumn("_sign", F.lit(-1))
    )
    surplus = signed.groupBy(*left.columns).agg(F.sum("_sign").alias("_surplus"))
    only_left = F.sum(F.greatest("_surplus", F.lit(0)))
    only_right = F.sum(F.greatest(-F.col("_surplus"), F.lit(0)))
    return surplus.agg(
        F.coalesce(only_left, F.lit(0)).alias("only_left"),
        F.coalesce(only_right, F.lit(0)).alias("only_right"),
    ).withColumn("identical", (F.col("only_left") + F.col("only_right")) == 0)


def compare_all(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """:func:`difference` of several named pairs, one row each."""
    rows = [
        difference(left, right).select(F.lit(name).alias("result"), "*")
        for name, (left, right) in pairs.items()
    ]
    return reduce(DataFrame.unionByName, rows)
