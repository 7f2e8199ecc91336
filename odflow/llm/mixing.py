"""Mixing sources to target weights by weighted fair queueing; DataFrame code only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odflow.llm.names import fresh
from odflow.llm.running import running_total
from odflow.sources.scratch import materialize

_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float
) -> DataFrame:
    """``(source, source_rank, source_size, target)`` from ``(source, size)`` rows.

    Sources are ranked by code point, null last, and take ``weights`` in turn. The
    budget is ``share`` of all sizes. A source's target stops at ``cap`` times its
    size; what is above goes to the others by weight until none is above. The water
    level at which that holds follows from running sums over the sources in the order
    in which they reach their caps. The windows see one row per source.
    """
    totals = materialize(
        sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes"
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1).alias("source_rank")
    ranked = totals.select("source", "source_size", turn)
    weight = F.element_at(
        F.array(*(F.lit(float(w)) for w in weights)),
        (F.col("source_rank") % len(weights) + 1).cast("int"),
    )
    room = ranked.withColumn("weight", weight).withColumn(
        "room", F.col("source_size") * F.lit(float(cap))
    )
    fill = Window.orderBy(F.col("room") / F.col("weight"), "source_rank")
    behind = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ahead = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.sum("source_size").over(everything) * F.lit(float(share))
    filled = F.coalesce(F.sum("room").over(ahead), F.lit(0.0))
    leveled = room.withColumn(
        "level", (budget - filled) / F.sum("weight").over(behind)
    )
    holds = F.col("level") * F.col("weight") <= F.col("room")
    level = F.coalesce(
        F.max(F.when(holds, F.col("level"))).over(everything),
        F.max(F.col("room") / F.col("weight")).over(everything),
    )
    return leveled.select(
        "source",
        "source_rank",
        "source_size",
        F.least("room", level * F.col("weight")).alias("target"),
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, taken)`` of every row.

    A source's documents are queued in the order of a hash of their ids, and again
    from the start when the queue is through, ``cap`` times at most. A document's
    virtual finish time is the number of words of its source up to its end, divided by
    the source's target. All documents are sorted by that time across the sources, and
    the first are taken as long as their words fit the budget. ``copies`` is how often
    a document is taken, ``taken`` its words times that.

    The order depends on ids alone, so reruns agree. Rows with the same id, source and
    size stand in the queue as one. A null or text without words has size 0 and is
    never taken; a null source is a source of its own. An empty table gives no rows.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
    )
    rows = materialize(rows, "mix-sizes")
    targets = materialize(source_targets(rows, weights, share, cap), "mix-targets")
    queue = (
        rows.groupBy("doc_id", "source", "size")
        .agg(F.count("*").alias("rows"))
        .withColumn("key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
        .withColumn("load", F.col("size") * F.col("rows"))
    )
    order = ["key", "doc_id", "size"]
    queue = running_total(queue, order, "load", "done", group=["source"])
    t = targets.select(
        F.col("source").alias("_source"), "source_rank", "source_size", "target"
    )
    queue = queue.join(t, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    queue = materialize(queue, "mix-queue")
    turns = range(int(cap))

    def place(turn: Column) -> Column:
        """Where a document's turn stands among all sources."""
        words = F.col("done") + turn * F.col("source_size")
        finish = words / F.nullif(F.col("target"), F.lit(0.0))
        return F.struct(
            finish.alias("finish"), "source_rank", turn.alias("turn"), *order
        )

    turn = F.explode(F.array(*(F.lit(i) for i in turns))).alias("turn")
    events = (
        queue.filter(F.col("size") > 0)
        .select("*", turn)
        .select(place(F.col("turn")).alias("place"), "load")
    )
    served = running_total(events, ["place"], "load", "served")
    budget = targets.agg(F.sum("source_size") * F.lit(float(share))).scalar()
    last = served.filter(F.col("served") <= budget).agg(F.max("place").alias("last"))
    last = materialize(last, "mix-cut")
    in_time = [
        F.when(F.coalesce(place(F.lit(i)) <= last.scalar(), F.lit(False)), 1).otherwise(0)
        for i in turns
    ]
    copies = F.when(F.col("size") > 0, reduce(lambda a, b: a + b, in_time)).otherwise(0)
    return (
        queue.withColumn("copies", copies)
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            F.explode(F.sequence(F.lit(1).cast("bigint"), "rows")).alias("_row"),
            "copies",
        )
        .drop("_row")
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def take_mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as :func:`mix` takes them, all columns kept.

    Whatever else the columns of ``docs`` are called, they come out as they were.
    """
    mix_id, mix_source, mix_size, copies, words, copy = fresh(
        docs, "_mix_id", "_mix_source", "_mix_size", "_mix_copies", "_mix_words", "_mix_copy"
    )
    chosen = (
        mix(docs, **options)
        .filter(F.col("copies") > 0)
        .select(
            F.col("doc_id").alias(mix_id),
            F.col("source").alias(mix_source),
            F.col("size").alias(mix_size),
            F.col("copies").alias(copies),
        )
        .distinct()
    )
    chosen = materialize(chosen, "mix-chosen")
    id_col, source = options.get("id_col", "doc_id"), options.get("source_col", "source")
    text = options.get("text_col", "text")
    found = docs.withColumn(words, word_count(F.col(text))).join(
        chosen,
        F.col(id_col).eqNullSafe(F.col(mix_id))
        & F.col(source).eqNullSafe(F.col(mix_source))
        & (F.col(words) == F.col(mix_size)),
    )
    turns = F.explode(F.sequence(F.lit(1), F.col(copies)))
    return found.select(*(found[f"`{c}`"] for c in docs.columns), turns.alias(copy)).drop(copy)
