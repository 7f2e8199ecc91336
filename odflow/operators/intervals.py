"""Joins of intervals that overlap, by bins whose width follows the interval.

An interval is put into bins of the power of two that is next above its length, so it lies
in two bins at most, whether it lasts a second or a century. A start is looked up in one
bin of every width that its key has. A pair is found from the one that starts later, which
starts in exactly one bin of each width: the pair has one owner, and no duplicates arise.
Of the starts in the bins of an interval, about a third or more lie inside it, so the rows
compared are in proportion to the matches. A key on most of the rows is split by bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflow.sources.scratch import materialize


def ticks(column: str, data_type: str) -> Column:
    """Whole numbers for a bound: microseconds, days, or the number itself."""
    if data_type == "timestamp_ntz":
        return F.unix_micros(F.col(column).cast("timestamp"))
    if data_type == "timestamp":
        return F.unix_micros(F.col(column))
    if data_type == "date":
        return F.unix_date(F.col(column)).cast("bigint")
    if data_type in ("bigint", "int", "smallint", "tinyint"):
        return F.col(column).cast("bigint")
    raise ValueError(f"bounds of type {data_type} are not supported")


def _bounded(df: DataFrame, keys: list[str], start: str, end: str, side: str) -> DataFrame:
    """Keys, bounds and the whole row; empty, null and keyless intervals are left out."""
    types = dict(df.dtypes)
    bounds = {"_s": ticks(start, types[start]), "_e": ticks(end, types[end])}
    rows = df.select(
        *(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)),
        *(c.alias(n) for n, c in bounds.items()),
        F.struct(*df.columns).alias(side),
    )
    for i in range(len(keys)):
        rows = rows.filter(F.col(f"_k{i}").isNotNull())
    return rows.filter(F.col("_s") < F.col("_e"))


def _level() -> Column:
    """The bits of the length less one: 2 ** level is the length or more."""
    length = F.col("_e") - F.col("_s") - 1
    return F.when(length <= 0, 0).otherwise(F.length(F.bin(length))).cast("int")


def _starts_inside(
    spans: DataFrame, starts: DataFrame, n_keys: int, inside: Column
) -> DataFrame:
    """Pairs of a span ``x`` and a row ``y`` that starts in it, by equal bins."""
    keys = [f"_k{i}" for i in range(n_keys)]
    first, last = (F.expr(f"shiftright({bound}, _level)") for bound in ("_s", "_e - 1"))
    spans = spans.withColumn("_level", _level())
    spans = spans.withColumn("_bin", F.explode(F.sequence(first, last)))
    widths = materialize(spans.select(*keys, "_level").distinct(), "interval-widths")
    looked = starts.join(widths, keys).withColumn("_bin", F.expr("shiftright(_s, _level)"))
    x, y = spans.alias("x"), looked.alias("y")
    same = F.lit(True)
    for c in [*keys, "_level", "_bin"]:
        same = same & (F.col(f"x.{c}") == F.col(f"y.{c}"))
    begins = (F.col("x._s") <= F.col("y._s")) & (F.col("y._s") < F.col("x._e"))
    return x.join(y, same & begins & inside)


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    by: list[tuple[str, str]],
    left_bounds: tuple[str, str],
    right_bounds: tuple[str, str],
) -> DataFrame:
    """``(left, right)``: structs of the rows whose intervals overlap and whose keys agree.

    Intervals hold their start and not their end. Every pair comes once for each pair of
    rows. Empty intervals, null bounds and null keys overlap with nothing. Bounds are
    timestamps, dates or whole numbers, of the same type on both sides.
    """
    a = _bounded(left, [l for l, _ in by], *left_bounds, "row")
    b = _bounded(right, [r for _, r in by], *right_bounds, "row")
    a, b = materialize(a, "intervals"), materialize(b, "intervals")
    # Equal starts count for the left side only.
    later = _starts_inside(a, b, len(by), F.lit(True)).select(
        F.col("x.row").alias("left"), F.col("y.row").alias("right")
    )
    earlier = _starts_inside(b, a, len(by), F.col("x._s") < F.col("y._s")).select(
        F.col("y.row").alias("left"), F.col("x.row").alias("right")
    )
    return later.unionByName(earlier)


def overlaps(
    df: DataFrame, keys: list[str], bounds: tuple[str, str], order: list[str]
) -> DataFrame:
    """``(left, right)``: pairs of rows of one table whose intervals overlap, each once.

    ``left`` starts first; at equal starts it has the smaller ``order`` columns, which must
    tell rows apart and are not null. See :func:`overlap_join`.
    """
    rows = materialize(_bounded(df, keys, *bounds, "row"), "intervals")
    place = [F.struct(f"{s}._s", *(F.col(f"{s}.row").getField(c) for c in order)) for s in "xy"]
    pairs = _starts_inside(rows, rows, len(keys), place[0] < place[1])
    return pairs.select(F.col("x.row").alias("left"), F.col("y.row").alias("right"))
