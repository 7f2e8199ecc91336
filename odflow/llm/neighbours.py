"""Approximate nearest neighbours by windows on shifted Hilbert curves.

Every curve orders the vectors by the Hilbert key of a few random projections, shifted
by a random offset. In Spark the keys are range-partitioned into ranks; a query looks
at the vectors whose rank is within a window of its own, on each curve, and what the
windows give is merged and ranked by the exact cosine.

The width of the windows is measured, not set: for a bounded sample of queries the true
neighbours are found by brute force, and the window is made wide enough to hold the
wanted share of them on one curve at least. Where vectors have little structure in many
dimensions, that is a large share of all ranks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odflow.llm.running import running_total
from odflow.sources.scratch import materialize

CURVES = 4
AXES = 8
BITS = 6
BLOCK = 2048
SPAN = 65_536  # ranks whose queries meet a block together
SAMPLE = 200
RECALL = 0.96


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position of integer cells, one row per point, on the Hilbert curve."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            hit = (x[i] & q) > 0
            swap = np.where(hit, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] = np.where(hit, x[0] ^ (q - 1), x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[n - 1] & q, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


def curve_keys(vectors: np.ndarray, curve: int, axes: int = AXES, bits: int = BITS) -> np.ndarray:
    """Hilbert keys of unit vectors on one of the curves."""
    dim = vectors.shape[1]
    axes = min(axes, dim)
    rng = np.random.default_rng(1000 + curve)
    frame = np.linalg.qr(rng.normal(size=(dim, dim)))[0][:, :axes]
    # A projection of a unit vector has a spread of about 1 / sqrt(dim).
    spread = (vectors @ frame) * np.sqrt(dim) / 6 + 0.5 + rng.uniform(-0.1, 0.1, axes)
    top = (1 << bits) - 1
    return hilbert_key(np.clip(spread * (top + 1), 0, top), bits)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows times a power of two, so that their squares neither overflow nor vanish.

    The cosine of such rows is the same to the last bit.
    """
    exponent = np.frexp(np.abs(vectors).max(1, keepdims=True, initial=0.0))[1]
    return np.ldexp(vectors, -exponent)


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a column, each scaled."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return scaled(flat.reshape(len(column), -1)) if len(column) else flat.reshape(0, 0)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine by rows, in double precision and a fixed order of terms."""
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def _largest(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k largest scores of every row; masked ones are -inf."""
    k = min(k, scores.shape[1])
    column = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    row = np.repeat(np.arange(len(scores)), k)
    column = column.reshape(-1)
    real = np.isfinite(scores[row, column])
    return row[real], column[real]


def sound(vector: Column) -> Column:
    """Not null, not zero, and all components finite."""
    finite = F.forall(
        vector,
        lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))),
    )
    return F.coalesce(finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def _classes(rows: DataFrame, k: int) -> DataFrame:
    """``(rep, ids, vector)``: distinct vectors with their k + 1 smallest ids.

    A vector that very many rows share is compared once, and the limit per vector is
    taken in the map tasks already.
    """
    place = F.row_number().over(Window.partitionBy("hash", "vector").orderBy("id"))
    few = rows.withColumn("hash", F.xxhash64("vector")).withColumn("_n", place)
    few = few.filter(F.col("_n") <= k + 1)
    return few.groupBy("hash", "vector").agg(
        F.min("id").alias("rep"), F.array_sort(F.collect_list("id")).alias("ids")
    ).select("rep", "ids", "vector")


def _ranked(classes: DataFrame, curves: int) -> DataFrame:
    """``(curve, rank, rep, vector)``: the place of every distinct vector on each curve."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _unit(_matrix(batch.column(1)))
            for curve in range(curves):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(unit), curve, np.int32)),
                        pa.array(curve_keys(unit, curve)),
                        batch.column(0),
                        batch.column(1),
                        pa.array(np.ones(len(unit), np.int64)),
                    ],
                    ["curve", "key", "rep", "vector", "_one"],
                )

    kind = classes.schema["vector"].dataType.simpleString()
    keyed = classes.select("rep", "vector").mapInArrow(
        keys, f"curve int, key bigint, rep bigint, vector {kind}, _one bigint"
    )
    ranked = running_total(keyed, ["key", "rep"], "_one", "rank", group=["curve"])
    return materialize(ranked.select("curve", "rank", "rep", "vector"), "curve-ranks")


def _true_neighbours(classes: DataFrame, sample: list, k: int) -> DataFrame:
    """``(q, rep)``: the k nearest distinct vectors of the sample, by brute force."""
    ids = np.array([r["rep"] for r in sample])
    unit = _unit(scaled(np.array([r["vector"] for r in sample], float)))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            reps = batch.column(0).to_numpy()
            scores = unit @ _unit(_matrix(batch.column(1))).T
            scores[ids[:, None] == reps[None, :]] = -np.inf
            row, column = _largest(scores, k)
            best.append((ids[row], reps[column], scores[row, column]))
        if best:
            q, rep, score = (np.concatenate(x) for x in zip(*best, strict=True))
            frame = pd.DataFrame({"q": q, "rep": rep, "score": score})
            frame = frame.sort_values("score", ascending=False).groupby("q").head(k)
            yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

    found = classes.select("rep", "vector").mapInArrow(
        nearest, "q bigint, rep bigint, score double"
    )
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "rep"))
    return found.withColumn("_n", place).filter(F.col("_n") <= k).select("q", "rep")


def window_width(
    classes: DataFrame, ranked: DataFrame, queries: DataFrame, k: int, recall: float
) -> int:
    """Ranks on either side that hold ``recall`` of the true neighbours of a sample.

    At most ``SAMPLE`` queries, chosen by a hash of their ids, are compared with all
    vectors; the distances of their neighbours are the only rows that are collected.
    """
    by_hash = queries.orderBy(F.xxhash64(F.lit(5), "rep"), "rep").limit(SAMPLE)
    sample = by_hash.select("rep", "vector").collect()
    if not sample:
        return 0
    truth = materialize(_true_neighbours(classes, sample, k), "true-neighbours")
    place = ranked.select("curve", "rep", "rank")
    of_q = F.broadcast(truth.select("q").distinct())  # at most SAMPLE rows
    asked = place.join(of_q, F.col("rep") == F.col("q"), "left_semi").select(
        F.col("rep").alias("q"), F.col("curve").alias("qc"), F.col("rank").alias("qr")
    )
    asked = materialize(asked, "sample-ranks")
    there = place.join(F.broadcast(truth), "rep")  # at most SAMPLE * k rows
    apart = (
        there.join(asked, (there["q"] == asked["q"]) & (F.col("curve") == F.col("qc")))
        .groupBy(there["q"], "rep")
        .agg(F.min(F.abs(F.col("rank") - F.col("qr"))).alias("apart"))
    )
    far = np.sort([r["apart"] for r in apart.select("apart").collect()])
    return int(far[min(len(far) - 1, int(np.ceil(recall * len(far))))]) if len(far) else 0


def _search(left: pa.Table, right: pa.Table, k: int, width: int) -> pa.Table:
    """The k nearest rows of a block for every query, within the query's window."""
    schema = pa.schema([("query_id", pa.int64()), ("rep", pa.int64()), ("score", pa.float64())])
    if not left.num_rows or not right.num_rows:
        return schema.empty_table()
    asked, given = _matrix(left.column("vector")), _matrix(right.column("vector"))
    scores = _unit(asked) @ _unit(given).T
    apart = left.column("rank").to_numpy()[:, None] - right.column("rank").to_numpy()[None, :]
    scores[np.abs(apart) > width] = -np.inf
    row, column = _largest(scores, k)
    return pa.table(
        [
            left.column("query_id").combine_chunks().take(pa.array(row)),
            right.column("rep").combine_chunks().take(pa.array(column)),
            pa.array(cosine(asked[row], given[column])),
        ],
        schema=schema,
    )


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    curves: int = CURVES,
    recall: float = RECALL,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest found of every query.

    ``is_query`` marks the queries among the rows; all rows but the query's own are
    candidates. Nearest first by cosine, ties to the smaller id; with fewer candidates,
    all of them. Vectors that are null or zero, or hold null or non-finite components,
    take no part, nor do those of another length than most. An id that several rows
    have counts once per different vector. A null id takes no part.
    """
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(vector_col).alias("vector"),
        is_query.alias("asked"),
    )
    rows = rows.filter(F.col("id").isNotNull() & sound(F.col("vector")))
    lengths = rows.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("rows"))
    usual = lengths.orderBy(F.desc("rows"), "n").limit(1).select("n").collect()
    if not usual:
        return rows.sparkSession.createDataFrame(
            [], "query_id bigint, rank int, vec_id bigint, score double"
        )
    rows = rows.filter(F.size("vector") == usual[0]["n"])
    classes = materialize(_classes(rows.select("id", "vector"), k), "vector-classes")
    ranked = _ranked(classes, curves)
    asked = rows.filter("asked").select(F.col("id").alias("query_id"), F.col("vector").alias("_v"))
    asked = materialize(
        asked.join(classes, F.col("_v") == F.col("vector")).select("query_id", "rep", "vector"),
        "queries",
    )
    width = window_width(
        classes, ranked, asked.select("rep", "vector").distinct(), k + 1, recall
    )
    own = ranked.select("curve", "rank", F.col("rep").alias("_rep"))
    asked = asked.join(own, F.col("rep") == F.col("_rep"))
    low = F.greatest(F.col("rank") - width, F.lit(0))
    left = asked.select(
        "curve",
        F.explode(
            F.sequence((low / BLOCK).cast("bigint"), ((F.col("rank") + width) / BLOCK).cast("bigint"))
        ).alias("block"),
        (F.col("rank") / SPAN).cast("bigint").alias("part"),
        "query_id",
        "rank",
        "vector",
    )
    block = (F.col("rank") / BLOCK).cast("bigint")
    first = F.greatest(block * BLOCK - width, F.lit(0))
    right = ranked.select(
        "curve",
        block.alias("block"),
        F.explode(
            F.sequence(
                (first / SPAN).cast("bigint"),
                (((block + 1) * BLOCK + width) / SPAN).cast("bigint"),
            )
        ).alias("part"),
        "rank",
        "rep",
        "vector",
    )
    left = materialize(left, "query-windows")
    keys = ["curve", "block", "part"]
    found = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInArrow(
            partial(_search, k=k + 1, width=width), "query_id bigint, rep bigint, score double"
        )
    )
    return _merged(materialize(found, "window-results"), classes, k)


def _merged(found: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """The k nearest rows of each query, from the nearest distinct vectors of the windows."""
    order = [F.desc("score"), "rep"]
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    best = (
        found.distinct()
        .withColumn("_n", place)
        .filter(F.col("_n") <= k + 1)
        .join(classes.select("rep", "ids"), "rep")
        .select("query_id", "score", F.explode("ids").alias("vec_id"))
        .filter(F.col("vec_id") != F.col("query_id"))
    )
    rank = F.row_number().over(
        Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    )
    return (
        best.withColumn("rank", rank)
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
