"""As-of join: every row with the latest earlier row of another table.

Both tables go into one order by key and time and are cut into slices. Inside a slice a
window carries the last row of the right side forward; the last one of earlier slices
comes from a table with one row per border. Nothing is compared pair by pair, and a key
on most of the rows is spread over many slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odflow.operators.ranged import SLICE, carried, sliced


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    by: list[tuple[str, str]],
    left_time: str,
    right_time: str,
    take: dict[str, str],
    tie: list[str],
    direction: str = "backward",
    allow_equal: bool = True,
    within: Column | None = None,
) -> DataFrame:
    """``left`` with the columns ``take`` (new name -> name in ``right``) of its match.

    The match is the row of ``right`` with equal keys ``by`` (left name, right name) and
    the latest ``right_time`` that is not after ``left_time`` (``direction="forward"``: the
    earliest that is not before it); without ``allow_equal`` equal times do not match. Of
    several rows at that time it is the one with the greatest ``tie`` columns, null least
    (forward: the least). ``within`` limits the distance, such as ``F.expr("INTERVAL 1 DAY")``;
    a match farther away counts as none.

    Every row of ``left`` gives one row. Without a match, or with a null key or time, the new
    columns are null. Rows of ``right`` with a null key or time match nothing.
    """
    if direction not in ("backward", "forward"):
        raise ValueError("direction must be backward or forward")
    clash = set(take) & set(left.columns)
    if clash:
        raise ValueError(f"left has the columns {sorted(clash)} already")
    forward = direction == "forward"
    keys = [f"_k{i}" for i in range(len(by))]
    # At one time, the side that may be seen by the other comes first.
    first, second = (0, 1) if allow_equal else (1, 0)
    left_rows = left.select(
        *(F.col(l).alias(k) for (l, _), k in zip(by, keys, strict=True)),
        F.col(left_time).alias("_t"),
        F.lit(second).alias("_side"),
        F.struct(*left.columns).alias("_row"),
    )
    right_rows = right.select(
        *(F.col(r).alias(k) for (_, r), k in zip(by, keys, strict=True)),
        F.col(right_time).alias("_t"),
        F.lit(first).alias("_side"),
        F.struct(*tie).alias("_tie"),
        F.struct(
            F.col(right_time).alias("_at"), *(F.col(c).alias(n) for n, c in take.items())
        ).alias("_match"),
    )
    for key in [*keys, "_t"]:
        right_rows = right_rows.filter(F.col(key).isNotNull())
    both = left_rows.unionByName(right_rows, allowMissingColumns=True)
    turn = F.desc if forward else F.asc
    order = [*(F.asc(k) for k in keys), turn("_t"), F.asc("_side"), turn("_tie")]
    rows = sliced(both, order, "as-of-rows")
    here = Window.partitionBy(SLICE, *keys).orderBy(*order[len(keys) :]).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    final = F.min_by if forward else F.max_by
    per_slice = (
        rows.filter(F.col("_match").isNotNull())
        .groupBy(SLICE, *keys)
        .agg(final("_match", F.struct("_t", "_tie")).alias("_match"))
    )
    # A slice that has the key, but no row of the right side, hands on what it was given.
    present = rows.select(SLICE, *keys).distinct().join(per_slice, [SLICE, *keys], "left")
    border = carried(present, keys, "_match", "_carried")
    found = (
        rows.withColumn("_near", F.last("_match", ignorenulls=True).over(here))
        .filter(F.col("_row").isNotNull())
        .join(border, [SLICE, *keys], "left")
        .withColumn("_found", F.coalesce("_near", "_carried"))
    )
    usable = F.col("_t").isNotNull()
    if within is not None:
        reach = (
            F.col("_found._at") <= F.col("_t") + within
            if forward
            else F.col("_t") <= F.col("_found._at") + within
        )
        usable = usable & reach
    match = F.when(usable, F.col("_found"))
    return found.withColumn("_found", match).select(
        "_row.*", *(F.col("_found").getField(n).alias(n) for n in take)
    )
