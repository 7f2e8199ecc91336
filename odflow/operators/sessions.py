"""Sessions: runs of a key's rows without a gap, merged across slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odflow.operators.ranged import SLICE, sliced
from odflow.sources.scratch import materialize

_MERGE = {"sum": F.sum, "min": F.min, "max": F.max}


def sessions(
    events: DataFrame,
    keys: list[str],
    time: str,
    gap: str,
    measures: dict[str, tuple[str, Column]] | None = None,
) -> DataFrame:
    """``(keys, session_start, session_end, n_rows, measures)``, one row per session.

    A row belongs to the session of the row before it if it comes less than ``gap`` (an
    interval such as ``"30 minutes"``) later. ``session_end`` is the time of the last row.
    ``measures`` maps a name to ``("sum" | "min" | "max", column)``. Rows without a time belong
    to no session; a null key is a key.

    Sessions are formed inside slices first. Those that are neither the first nor the
    last of their key in a slice are settled; only the others, two per slice and key
    at most, are merged over the borders, so a key on most of the rows is never one group.
    """
    measures = {"n_rows": ("sum", F.lit(1).cast("bigint")), **(measures or {})}
    rows = events.filter(F.col(time).isNotNull()).select(
        *keys, F.col(time).alias("_t"), *(c.alias(n) for n, (_, c) in measures.items())
    )
    rows = sliced(rows, [*(F.asc(k) for k in keys), F.asc("_t")], "session-rows")
    limit = F.expr(f"INTERVAL {gap}")
    local = Window.partitionBy(SLICE, *keys).orderBy("_t")
    opens = F.coalesce(F.col("_t") >= F.lag("_t").over(local) + limit, F.lit(True))
    numbered = rows.withColumn("_opens", opens.cast("int")).withColumn(
        "_n", F.sum("_opens").over(local.rowsBetween(Window.unboundedPreceding, 0))
    )
    parts = numbered.groupBy(SLICE, *keys, "_n").agg(
        F.min("_t").alias("session_start"),
        F.max("_t").alias("session_end"),
        *(_MERGE[how](n).alias(n) for n, (how, _) in measures.items()),
    )
    per_key = Window.partitionBy(SLICE, *keys)
    parts = parts.withColumn(
        "_border", (F.col("_n") == 1) | (F.col("_n") == F.max("_n").over(per_key))
    )
    parts = materialize(parts, "session-parts")
    out = [*keys, "session_start", "session_end", *measures]
    settled = parts.filter(~F.col("_border")).select(*out)
    along = Window.partitionBy(*keys).orderBy(SLICE, "_n")
    apart = F.coalesce(
        F.col("session_start") >= F.lag("session_end").over(along) + limit, F.lit(True)
    )
    border = parts.filter("_border").withColumn("_opens", apart.cast("int"))
    border = border.withColumn(
        "_m", F.sum("_opens").over(along.rowsBetween(Window.unboundedPreceding, 0))
    )
    merged = border.groupBy(*keys, "_m").agg(
        F.min("session_start").alias("session_start"),
        F.max("session_end").alias("session_end"),
        *(_MERGE[how](n).alias(n) for n, (how, _) in measures.items()),
    )
    return settled.unionByName(merged.select(*out))
