"""Toxicity of whole texts from subword-bag embeddings and a linear softmax.

A word's vector is the mean of the embeddings of its character n-grams, a text's
vector the mean over its words; two outputs with a softmax stand on it. Embeddings and
outputs are trained jointly. A misspelled word shares most n-grams with the word it
stands for, so it lands near it even if it was never seen.

Words are runs of letters, digits and bytes above 127, in lower case for A-Z.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflow.llm.text import (
    LOWER,
    Words,
    run_hashes,
    split_words,
    text_buffers,
    text_slices,
)
from odflow.llm.transducer import HashTable
from odflow.sources.scratch import materialize

BUCKETS = 1 << 18
GRAMS = (3, 4, 5, 6)
MAX_ROWS = 2500  # of each class
MAX_BYTES = 10_000
KNOWN_WORDS = 1 << 18

SEPARATOR = np.ones(256, bool)
SEPARATOR[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def plain_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    return split_words(LOWER[data], offsets, SEPARATOR)


def word_grams(words: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of the chosen words and of the words, with offsets.

    Words are bracketed, so that n-grams at their edges differ from inner ones.
    """
    starts, ends = words.starts[which], words.ends[which]
    sizes = ends - starts + 2
    base = np.concatenate([[0], np.cumsum(sizes)])
    data = np.empty(base[-1], np.uint8)
    owner = np.repeat(np.arange(len(which), dtype=np.int32), sizes)
    inside = np.arange(base[-1], dtype=np.int32) - base[owner].astype(np.int32)
    source = np.clip(starts[owner] + inside - 1, 0, max(len(words.data) - 1, 0))
    if len(data):
        data[:] = words.data[source]
    data[base[:-1]] = ord("<")
    data[base[1:] - 1] = ord(">")
    buckets = lambda at, to: (
        run_hashes(data, at, to) % np.uint64(BUCKETS)
    ).astype(np.int32)
    pieces = [buckets(base[:-1], base[1:])]
    owners = [np.arange(len(which), dtype=np.int32)]
    for n in GRAMS:
        at = np.flatnonzero(inside + n <= sizes[owner])
        at = at[sizes[owner[at]] > n]  # the whole word has its own entry
        pieces.append(buckets(at, at + n))
        owners.append(owner[at])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(pieces)[order], np.searchsorted(owner[order], np.arange(len(which) + 1))


@dataclass
class Model:
    """``gram_score`` has what an n-gram adds to the log odds, by bucket."""

    gram_score: np.ndarray
    bias: float


def train(
    texts: pa.Array,
    labels: np.ndarray,
    dim: int = 4,
    rounds: int = 120,
    rate: float = 0.3,
    decay: float = 1e-7,
    seed: int = 7,
) -> Model:
    """Fit embeddings and softmax together by Adam over all rows at once.

    The log odds are linear in the embeddings, so the slope of an embedding is a
    number times the output vector; only these numbers pass through words and texts.
    """
    labels = np.asarray(labels, np.float64)
    if not len(labels) or labels.min() == labels.max():
        share = (labels.sum() + 0.1) / (len(labels) + 1.0)
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))
    words = plain_words(*text_buffers(texts))
    _, first, word = np.unique(words.hashes(), return_index=True, return_inverse=True)
    pair, times = np.unique(words.doc() * len(first) + word, return_counts=True)
    pair_doc, pair_word = pair // len(first), pair % len(first)
    weight = times / words.counts[pair_doc]
    del word, pair, times
    grams, at = word_grams(words, first)
    seen = np.zeros(BUCKETS, bool)
    seen[grams] = True
    used = np.flatnonzero(seen)
    gram = (np.cumsum(seen) - 1)[grams]
    del grams
    per_word = np.diff(at)
    word_of_gram = np.repeat(np.arange(len(first)), per_word)
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (len(used), dim))
    out = rng.normal(0, 1.0, dim)  # difference of the two outputs
    prior = labels.mean()
    bias = np.array([np.log(prior / (1 - prior))])
    values = (embed, out, bias)
    moments = [(np.zeros_like(v), np.zeros_like(v)) for v in values]
    for step in range(1, rounds + 1):
        of_word = np.add.reduceat((embed @ out)[gram], at[:-1]) / per_word
        odds = np.bincount(pair_doc, of_word[pair_word] * weight, len(labels)) + bias
        error = 1 / (1 + np.exp(-np.clip(odds, -30, 30))) - labels
        error /= len(labels)
        back = np.bincount(pair_word, error[pair_doc] * weight, len(first)) / per_word
        slope = np.bincount(gram, back[word_of_gram], len(used))
        slopes = (
            slope[:, None] * out + decay * embed,
            embed.T @ slope,
            error.sum(keepdims=True),
        )
        for value, (first_m, second_m), slope in zip(values, moments, slopes, strict=True):
            first_m += 0.1 * (slope - first_m)
            second_m += 0.01 * (slope * slope - second_m)
            unbiased = np.sqrt(second_m / (1 - 0.99**step)) + 1e-9
            value -= rate * first_m / (1 - 0.9**step) / unbiased
    scores = np.zeros(BUCKETS, np.float32)
    scores[used] = embed @ out
    return Model(scores, float(bias[0]))


class Scorer:
    """Scores slices of texts; remembers words, in a table of bounded size."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.known = HashTable(KNOWN_WORDS.bit_length())

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        words = plain_words(data, offsets)
        keys = words.hashes() | np.uint64(1)
        row = self.known.get(keys)
        if (row == -1).any():
            new, first = np.unique(keys[row == -1], return_index=True)
            first = np.flatnonzero(row == -1)[first]
            if self.known.size + len(new) > KNOWN_WORDS:
                self.known = HashTable(max(KNOWN_WORDS, len(keys)).bit_length())
                new, first = np.unique(keys, return_index=True)
            grams, at = word_grams(words, first)
            total = np.add.reduceat(self.model.gram_score[grams].astype(np.float64), at[:-1])
            mean = (total / np.diff(at)).astype(np.float32)
            self.known.put(new, mean.view(np.int32))
            row = self.known.get(keys)
        value = np.concatenate([[0.0], np.cumsum(row.view(np.float32), dtype=np.float64)])
        mean = (value[words.first[1:]] - value[words.first[:-1]]) / np.maximum(words.counts, 1)
        return 1 / (1 + np.exp(-np.clip(mean + self.model.bias, -30, 30)))


def in_training(id_col: Column) -> Column:
    """Rows whose label may be learned: crc32 of the id as text, modulo 4, is not 2."""
    return F.crc32(id_col.cast("string").cast("binary")) % 4 != 2


def training_rows(
    docs: DataFrame, labels: DataFrame, max_rows: int, id_col: str, text_col: str
) -> DataFrame:
    """``(text, toxic, share)`` of at most ``max_rows`` labelled rows of each class.

    Rows are chosen by a hash of the id; ``share`` is the share of toxic rows among all
    labelled ones. An id that several rows have counts once, with the least of its texts.
    Texts of more than ``MAX_BYTES`` are not learned from, so that the
    sample's size is bounded too.
    """
    marked = labels.filter(in_training(F.col("doc_id"))).filter(F.col("toxic").isin(0, 1))
    marked = marked.groupBy(F.col("doc_id").alias("_label_id")).agg(F.max("toxic").alias("toxic"))
    marked = materialize(marked, "toxic-labels")
    by_hash = [F.xxhash64(F.lit(2), "_label_id"), F.col("_label_id")]
    classes = [
        marked.filter(F.col("toxic") == c).orderBy(*by_hash).limit(max_rows) for c in (0, 1)
    ]
    share = marked.agg(F.avg("toxic").alias("share")).scalar()
    chosen = materialize(classes[0].union(classes[1]), "toxic-sample")
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    return (
        texts.filter(F.octet_length("text") <= MAX_BYTES)
        .join(F.broadcast(chosen), F.col("_id") == F.col("_label_id"))  # 2 max_rows rows
        .groupBy("_label_id")
        .agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
        .select("text", "toxic", "_label_id", share.alias("share"))
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = MAX_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Model:
    """A model from the labelled rows that are not held out.

    It is trained on classes of like size; the bias is set back to their true shares.
    """
    rows = training_rows(docs, labels, max_rows, id_col, text_col).toArrow()
    rows = rows.combine_chunks().sort_by([("_label_id", "ascending"), ("text", "ascending")])
    toxic = rows.column("toxic").to_numpy()
    model = train(rows.column("text"), toxic)
    if 0 < toxic.sum() < len(toxic):
        share, here = rows.column("share")[0].as_py(), toxic.mean()
        model.bias += float(np.log(share / (1 - share)) - np.log(here / (1 - here)))
    return model


def toxicity(
    docs: DataFrame,
    model: Model,
    threshold: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row; no shuffle.

    The score rests on the whole text alone. A null text, or one without words, gets
    the score of the bias. Without labels of both kinds the score is the same for all.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(~in_training(F.col(id_col)), F.lit(False)).alias("held_out"),
        F.col(text_col),
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(2)):
                found = scorer.scores(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(low, high - low) for i in (0, 1)),
                        pa.array(found),
                        pa.array((found >= threshold).astype(np.int32)),
                    ],
                    ["doc_id", "held_out", "score", "predicted"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        score, f"doc_id {kind}, held_out boolean, score double, predicted int"
    )
