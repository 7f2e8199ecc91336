"""Running totals over all rows without a single ordered partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odflow.sources.scratch import materialize


def null_safe(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Equality of several columns in which null equals null."""
    test = F.lit(True)
    for c in columns:
        test = test & left[c].eqNullSafe(right[c])
    return test


def running_total(
    df: DataFrame, order: list[str], value: str, out: str, group: list[str] | None = None
) -> DataFrame:
    """``df`` with the inclusive running sum of ``value`` in column ``out``.

    Rows are range-partitioned by group and order, so a group that holds most rows
    spreads over many slices, and written once. The totals of the slices, one row per
    slice and group, give the offset of each; within a slice a window adds the rest.
    ``order`` should tell rows apart; equal rows may change places.
    """
    group = group or []
    ranged = df.repartitionByRange(*group, *order).withColumn(
        "_slice", F.spark_partition_id()
    )
    table = materialize(ranged, f"running-{out}")
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        table.groupBy("_slice", *group)
        .agg(F.sum(value).alias("_sum"))
        .select(
            *(F.col(c).alias(f"_of_{c}") for c in ["_slice", *group]),
            F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"),
        )
    )
    offsets = materialize(offsets, f"offsets-{out}")
    within = Window.partitionBy("_slice", *group).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    same = F.col("_slice") == F.col("_of__slice")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return (
        table.withColumn("_within", F.sum(value).over(within))
        .join(offsets, same, "left")
        .withColumn(out, F.col("_within") + F.col("_before"))
        .select(*df.columns, out)
    )
