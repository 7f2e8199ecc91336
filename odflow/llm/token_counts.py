"""Token counts of whole texts by a compiled finite-state tokenizer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from odflow.llm.text import text_slices
from odflow.llm.transducer import tokenizer


def token_counts(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 1024,
) -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` of every row; no shuffle.

    ``path`` is a byte-level BPE file that every executor can read. Tokens are
    counted as the library does without added special tokens; special strings inside
    a text count as one token. A null or empty text has no tokens. Rows that repeat
    give repeated rows; other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = tokenizer(path)
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(1)):
                tokens = machine.counts(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array(np.diff(offsets)),
                        pa.array(tokens),
                        pa.array(tokens > limit),
                    ],
                    [id_col, "n_bytes", "n_tokens", "over_limit"],
                )

    return docs.select(id_col, text_col).mapInArrow(
        count, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
