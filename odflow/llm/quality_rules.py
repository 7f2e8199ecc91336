"""Rules on single texts, and verdicts on the hosts the texts come from."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflow.llm.text import mix64, run_hashes, split_words, sums, text_slices
from odflow.sources.scratch import materialize

# Fixed values of the rules.
MIN_WORDS = 20
WINDOW = 8
REPEAT_PERCENT = 30

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _repeated(doc: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have a key twice or more in their text, and which of them are later."""
    with np.errstate(over="ignore"):
        joint = mix64(keys + mix64(doc.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(joint, kind="stable")
    same = joint[order][1:] == joint[order][:-1]
    again, any_ = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    again[order[1:][same]] = True
    any_[order[1:][same]] = True
    any_[order[:-1][same]] = True
    return any_, again


def text_measures(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The measures of every text of a slice."""
    words = split_words(data, offsets)
    doc, counts = words.doc(), words.counts
    head = (data & 0xC0) != 0x80
    inside = np.zeros(len(data) + 1, np.int32)
    np.add.at(inside, words.starts, 1)
    np.add.at(inside, words.ends, -1)
    in_word = np.cumsum(inside[:-1]) > 0
    # Lines: between line feeds and the ends of texts; only those with a word count.
    feed = np.flatnonzero(data == 10)
    line_ends = np.sort(np.concatenate([feed, offsets[1:]]), kind="stable")
    line_starts = np.sort(np.concatenate([feed + 1, offsets[:-1]]), kind="stable")
    has_word = np.searchsorted(words.starts, line_starts) < np.searchsorted(
        words.starts, line_ends
    )
    line_starts, line_ends = line_starts[has_word], line_ends[has_word]
    line_doc = np.searchsorted(offsets, line_starts, "right") - 1
    _, later = _repeated(line_doc, run_hashes(data, line_starts, line_ends))
    # Windows of words.
    hashes = words.hashes()
    n_windows = np.maximum(counts - WINDOW + 1, 0)
    at = np.arange(n_windows.sum()) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    at = at + np.repeat(words.first[:-1], n_windows)
    key = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(WINDOW):
            key = key * np.uint64(0x9E3779B97F4A7C15) + hashes[at + k]
    twice, _ = _repeated(doc[at], key)
    cover = np.zeros(len(doc) + 1, np.int32)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + WINDOW, -1)
    covered = np.cumsum(cover[:-1]) > 0
    return {
        "n_words": counts.astype(np.int64),
        "word_chars": sums(head & in_word, offsets),
        "n_symbols": sums(_SYMBOL[data], offsets),
        "n_dup_lines": np.bincount(line_doc[later], minlength=len(counts)).astype(np.int64),
        "n_repeat_words": sums(covered, words.first),
    }


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """``(doc_id, host, measures..., base_failed)`` of every row; no shuffle.

    A null text has no words. A text fails with fewer than 20 words, or if windows of
    8 words that occur twice or more cover over 30 % of its words.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), F.col(text_col)
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(2)):
                found = text_measures(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(low, high - low) for i in (0, 1)),
                        *(pa.array(found[m]) for m in MEASURES),
                    ],
                    ["doc_id", "host", *MEASURES],
                )

    kinds = ", ".join(
        f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("doc_id", "host")
    )
    measured = rows.mapInArrow(
        measure, kinds + "".join(f", {m} bigint" for m in MEASURES)
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )
    return measured.withColumn("base_failed", failed)


def host_rates(base: DataFrame) -> DataFrame:
    """``(host, n_docs, n_failed, rate)``: failure rates shrunk by a beta prior.

    The prior is fitted to the hosts' own rates by moments: its mean is the rate of
    all documents, its strength follows from how much the hosts' rates spread beyond
    what their numbers of documents explain. A host without many documents keeps a
    rate near the mean.
    """
    hosts = materialize(
        base.groupBy("host").agg(
            F.count("*").alias("n_docs"), F.count_if("base_failed").alias("n_failed")
        ),
        "host-counts",
    )
    n, k = F.col("n_docs").cast("double"), F.col("n_failed").cast("double")
    total = hosts.agg(
        F.sum(n).alias("n"), F.sum(k).alias("k"), F.sum(n * n).alias("nn"), F.count("*").alias("h")
    ).first()
    if not total["h"]:
        return hosts.withColumn("rate", F.lit(0.0))
    mean = total["k"] / total["n"]
    spread = hosts.agg(F.sum(n * (k / n - mean) * (k / n - mean))).first()[0]
    within = mean * (1 - mean)
    # Method of moments for the variance between hosts.
    divisor = total["n"] - total["nn"] / total["n"]
    between = (spread - (total["h"] - 1) * within) / divisor if divisor > 0 else 0.0
    between = min(max(between, within * 1e-4), within * 0.99)
    strength = within / between - 1 if between > 0 else 1.0
    rate = (k + strength * mean) / (n + strength)
    return hosts.withColumn("rate", rate)


def quality_rules(docs: DataFrame, max_rate: float = 0.5, **columns) -> DataFrame:
    """``(doc_id, host, measures..., base_failed, host_rate, kept)`` of every row.

    ``kept`` is false for a text that fails the rules, and for every text of a host
    whose shrunk failure rate exceeds ``max_rate``. A null host is a host of its own.
    An empty table gives no rows.
    """
    base = materialize(base_rules(docs, **columns), "base-rules")
    hosts = host_rates(base).select(
        F.col("host").alias("_host"), F.col("rate").alias("host_rate")
    )
    return (
        base.join(hosts, F.col("host").eqNullSafe(F.col("_host")), "left")
        .drop("_host")
        .withColumn("kept", ~F.col("base_failed") & (F.col("host_rate") <= max_rate))
    )
