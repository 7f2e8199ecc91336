"""Rows in one global order, cut into slices that bound what a task holds.

The slices are ranges of the whole order, key first. A key with very many rows therefore
lies in several neighbouring slices, and a task sees only its part. What an operator has
to carry from one slice of a key to the next is one row per slice and key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odflow.sources.scratch import materialize

SLICE = "_slice"


def sliced(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """``df`` with the number of its slice, as a written table.

    Slices rise with the order. The number belongs to the written rows, so a lost
    executor does not deal them anew.
    """
    ranged = df.repartitionByRange(*order).withColumn(SLICE, F.spark_partition_id())
    return materialize(ranged, label)


def carried(per_slice: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """``(slice, keys, out)``: the last ``value`` that is set in an earlier slice of the key.

    ``per_slice`` has one row per slice and key. Only keys that lie in several slices
    have anything to carry, so the written table has about one row per slice.
    """
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(
        Window.unboundedPreceding, -1
    )
    found = per_slice.withColumn(out, F.last(value, ignorenulls=True).over(before))
    return materialize(found.filter(F.col(out).isNotNull()).select(SLICE, *keys, out), out)
