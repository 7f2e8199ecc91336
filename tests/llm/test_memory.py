"""Memory of the Python side of a task: it follows small slices, not the batch."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from odflow.llm import jaccard_join, near_dedup, quality_classifier
from odflow.llm.text import mix64
from odflow.sources.scratch import BATCH_ROWS, materialize


def peak_mb(rows):
    """Peak of what numpy and Python hold while ``rows`` is read to its end."""
    tracemalloc.start()
    try:
        n = sum(r.num_rows for r in rows)
        return n, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


@pytest.fixture(scope="module")
def batch():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(5000)]
    texts = [" ".join(rng.choices(words, k=350)) for _ in range(2000)]
    return pa.RecordBatch.from_arrays([pa.array(range(2000)), pa.array(texts)], ["doc_id", "text"])


def test_signatures_and_grams_stay_small(batch):
    n, mb = peak_mb(near_dedup._signatures([batch], 5))
    assert n == 2000 and mb < 60
    texts = batch.select(["text"])
    _, mb = peak_mb(quality_classifier._counts([texts]))
    assert mb < 80


def test_bands_stay_small():
    rows = [np.full(near_dedup.BUCKETS, i + 1, np.uint16).tobytes() for i in range(10_000)]
    table = pa.RecordBatch.from_arrays([pa.array(range(10_000)), pa.array(rows)], ["id", "registers"])
    n, mb = peak_mb(near_dedup._bands([table]))
    assert n == 10_000 * near_dedup.BANDS and mb < 20


def test_keys_of_a_task_stay_small():
    keys = mix64(np.arange(1 << 20, dtype=np.uint64)) & ~np.uint64(1)
    ids = np.arange(1 << 20, dtype=np.int64)
    step = 1 << 14
    cut = [(0, keys[i : i + step].tobytes(), ids[i : i + step].tobytes()) for i in range(0, len(keys), step)]
    types = pa.int32(), pa.binary(), pa.binary()
    dealt = [
        pa.RecordBatch.from_arrays(
            [pa.array([c], t) for c, t in zip(row, types, strict=True)], ["part", "keys", "ids"]
        )
        for row in [*cut, cut[0]]
    ]
    n, mb = peak_mb(jaccard_join._shared(dealt))
    # The same set has the repeated keys: nothing is shared.
    assert n == 0 and mb < 75


def test_batches_for_python_stay_small(spark):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"

    def most_rows():
        sizes = spark.range(0, 5000, 1, 1).mapInArrow(
            lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n bigint"
        )
        return max(r["n"] for r in materialize(sizes, "sizes").collect())

    before = spark.conf.get(setting, None)
    try:
        spark.conf.unset(setting)
        assert most_rows() == BATCH_ROWS
        spark.conf.set(setting, "2500")
        assert most_rows() == 2500
    finally:
        spark.conf.unset(setting)
        if before is not None:
            spark.conf.set(setting, before)
