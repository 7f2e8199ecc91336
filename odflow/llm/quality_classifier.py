"""Quality by importance resampling over hashed n-gram models.

Two generative models give the probability of a text's n-grams: one of all texts, one
of texts labelled good. The log of their ratio is a text's importance. Texts are
sampled without replacement in proportion to it: to every log weight comes a Gumbel
variate, and the largest k sums are kept.

N-grams are byte trigrams, words and word pairs, hashed into ``BUCKETS``; a word equal to the one before
it is read as a repeat sign.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflow.llm.names import fresh
from odflow.llm.running import running_total
from odflow.llm.text import SMALL_SLICE_BYTES, mix64, split_words, text_slices
from odflow.sources.scratch import materialize

BUCKETS = 1 << 17
MAX_ROWS = 20_000
SMOOTHING = 1.0
SEED = 11

_REPEAT = np.uint64(0x5851F42D4C957F2D)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of some texts, and the text of each."""
    wide = data.astype(np.uint64)
    with np.errstate(over="ignore"):
        tri = wide[:-2] << np.uint64(16) | wide[1:-1] << np.uint64(8) | wide[2:]
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        inside = owner[2:] == owner[:-2]
        words = split_words(data, offsets)
        hashes, doc = words.hashes(), words.doc()
        same_text = doc[1:] == doc[:-1]
        again = np.concatenate([[False], (hashes[1:] == hashes[:-1]) & same_text])
        hashes[again] = _REPEAT
        pairs = (hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])[same_text]
    keys = np.concatenate([mix64(tri[inside]), hashes, mix64(pairs)])
    owners = np.concatenate([owner[2:][inside], doc, doc[1:][same_text]])
    return (keys % np.uint64(BUCKETS)).astype(np.int64), owners


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-grams of a partition by bucket."""
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, _, data, offsets in text_slices(batch.column(0), SMALL_SLICE_BYTES):
            total += np.bincount(grams(data, offsets)[0], minlength=BUCKETS)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["bucket", "n"]
    )


def gram_counts(texts: DataFrame) -> np.ndarray:
    """N-grams of all texts by bucket; the result's size is fixed."""
    counted = texts.mapInArrow(_counts, "bucket int, n bigint")
    table = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS)
    out[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return out


@dataclass
class Model:
    """``weight`` has the log ratio by bucket; ``cut`` splits good from poor texts."""

    weight: np.ndarray
    cut: float


def text_weights(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean log ratio of every text's n-grams; 0 without any."""
    buckets, owner = grams(data, offsets)
    n = len(offsets) - 1
    total = np.bincount(owner, model.weight[buckets], n)
    return total / np.maximum(np.bincount(owner, minlength=n), 1)


def labelled_rows(
    docs: DataFrame, labels: DataFrame, max_rows: int, id_col: str, text_col: str
) -> DataFrame:
    """``(text, quality)`` of at most ``max_rows`` labelled rows, chosen by hash.

    An id that several rows have counts once, with the least of its texts.
    """
    marked = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    chosen = (
        marked.groupBy(F.col("doc_id").alias("_label_id"))
        .agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64(F.lit(SEED), "_label_id"), "_label_id")
        .limit(max_rows)
    )
    chosen = F.broadcast(materialize(chosen, "quality-labels"))  # at most max_rows rows
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    once = texts.join(chosen, F.col("_id") == F.col("_label_id")).groupBy("_label_id")
    return once.agg(F.min("text").alias("text"), F.max("quality").alias("quality")).select(
        "text", "quality"
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = MAX_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Model:
    """Models of all texts and of the labelled good ones, and the cut between classes.

    The cut is the weight that labels at least as many rows rightly as any other.
    Without good labelled rows all weights are 0; without poor ones nothing is cut.
    """
    rows = labelled_rows(docs, labels, max_rows, id_col, text_col)
    raw = gram_counts(docs.select(text_col))
    target = gram_counts(rows.filter(F.col("quality") == 1).select("text"))
    if not target.any():
        return Model(np.zeros(BUCKETS), float("-inf"))
    smooth = lambda c: (c + SMOOTHING) / (c.sum() + SMOOTHING * BUCKETS)
    model = Model(np.log(smooth(target)) - np.log(smooth(raw)), float("-inf"))
    seen = rows.select(F.lit(0).alias("id"), "text", "quality")
    table = _weigh(seen, model, "quality").toArrow()
    weight = table.column("weight").to_numpy()
    good = table.column("quality").to_numpy() == 1
    if good.all() or not good.any():
        return model
    order = np.argsort(weight, kind="stable")
    # Rows up to the cut count as poor: right are the poor ones below, the good above.
    right = np.cumsum(~good[order]) + good.sum() - np.cumsum(good[order])
    best = int(right.argmax())
    if right[best] > good.sum():
        above = weight[order[min(best + 1, len(order) - 1)]]
        model.cut = float((weight[order[best]] + above) / 2)
    return model


def _weigh(rows: DataFrame, model: Model, *keep: str) -> DataFrame:
    """The columns ``keep`` of rows ``(id, text, ...)``, and the text's ``weight``."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column("text"), SMALL_SLICE_BYTES):
                weights = text_weights(model, data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(low, high - low) for c in keep),
                        pa.array(weights),
                    ],
                    [*keep, "weight"],
                )

    kinds = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep]
    return rows.mapInArrow(weigh, ", ".join([*kinds, "weight double"]))


def quality(
    docs: DataFrame,
    model: Model,
    sharpness: float = 2000.0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, weight, key, kept)`` of every row.

    ``key`` is ``sharpness`` times the mean log ratio, plus a Gumbel variate that
    follows from the id. The k largest keys are kept, k being the number of texts above
    the model's cut. A null or empty text has weight 0. Rows with equal id and text
    have equal keys; at the end of the k rows one of two equal rows may be left.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    spin = F.xxhash64(F.lit(SEED), F.col("id")).cast("double") / F.lit(2.0**64) + F.lit(0.5)
    spin = F.least(F.greatest(spin, F.lit(1e-12)), F.lit(1 - 1e-12))
    keyed = _weigh(rows, model, "id").withColumn(
        "key", F.col("weight") * F.lit(sharpness) - F.log(-F.log(spin))
    )
    keyed = materialize(keyed, "importance")
    k = keyed.filter(F.col("weight") > model.cut).count()
    ranked = running_total(
        keyed.withColumn("_down", -F.col("key")).withColumn("_one", F.lit(1)),
        ["_down", "id"],
        "_one",
        "_rank",
    )
    return ranked.select(
        F.col("id").alias("doc_id"), "weight", "key", (F.col("_rank") <= k).alias("kept")
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that the sample keeps, all columns as they are.

    An id goes if none of its rows is kept; rows with a null id all stay. Whatever else
    the columns of ``docs`` are called, they come out as they were.
    """
    (gone_id,) = fresh(docs, "_gone")
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    verdict = quality(docs, model, id_col=id_col, text_col=text_col)
    gone = (
        verdict.groupBy(F.col("doc_id").alias(gone_id))
        .agg(F.max("kept").alias("any_kept"))
        .filter(~F.col("any_kept"))
        .select(gone_id)
    )
    gone = materialize(gone, "rejected")
    return docs.join(gone, F.col(id_col) == F.col(gone_id), "left_anti")
