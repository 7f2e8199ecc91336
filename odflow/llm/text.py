"""Words of whole texts as numpy arrays, straight from Arrow buffers.

A word is a run of bytes outside ``\\x20`` and ``\\x09-\\x0D``. Texts are handled in
slices of a few MB, so that memory follows the slice and not the batch; a text is
never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2_000_000
# For work that takes some dozens of bytes of memory per byte of text.
SMALL_SLICE_BYTES = 400_000
SMALL_BATCH_ROWS = 1000

_GAMMA = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all input bits."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _GAMMA)


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if n < len(self.up):
            return
        inverse = np.uint64(pow(int(_BASE), -1, 2**64))
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(n + 1, base, np.uint64)
            steps[0] = 1
            setattr(self, name, np.multiply.accumulate(steps))


_powers = _Powers()


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs ``data[starts[i]:ends[i]]``."""
    _powers.reach(len(data))
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, np.uint64)
        np.take(_BYTE, data, out=total[1:], mode="clip")
        total[1:] *= _powers.up[: len(data)]
        np.cumsum(total, out=total)
        raw = (total[ends] - total[starts]) * _powers.down[starts]
        return mix64(raw + (ends - starts).astype(np.uint64) * _GAMMA)


@dataclass
class Words:
    """The words of some texts. ``first`` has the word offsets of the texts."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        """The text of every word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return run_hashes(self.data, self.starts, self.ends)

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all n-word runs, and their offsets by text.

        A text with fewer words has its whole sequence as its only run; a text
        without words has none.
        """
        words, counts = self.hashes(), self.counts
        runs = np.maximum(counts - n + 1, np.minimum(counts, 1))
        first = np.concatenate([[0], np.cumsum(runs)])
        inside = np.arange(first[-1]) - np.repeat(first[:-1], runs)
        at = inside + np.repeat(self.first[:-1], runs)
        size = np.repeat(np.minimum(counts, n), runs)
        out = np.zeros(len(at), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(n):
                here = size > k
                if here.all():
                    out = out * _BASE + words[at + k]
                else:
                    out[here] = out[here] * _BASE + words[at[here] + k]
            out += size.astype(np.uint64) * _GAMMA
        return mix64(out), first


def split_words(
    data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE
) -> Words:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``."""
    n = len(data)
    inside = ~separator[data]
    begins = np.zeros(n + 1, bool)
    begins[offsets] = True
    before = np.empty(n, bool)
    after = np.empty(n, bool)
    if n:
        before[0], before[1:] = True, ~inside[:-1]
        after[-1], after[:-1] = True, ~inside[1:]
        before |= begins[:n]
        after |= begins[1:]
    starts = np.flatnonzero(inside & before)
    ends = np.flatnonzero(inside & after) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, ends


def text_slices(
    column: pa.Array, limit: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(low, high, data, offsets)`` for runs of rows of about ``limit`` bytes."""
    raw, ends = text_buffers(column)
    low, rows = 0, len(ends) - 1
    while low < rows:
        high = int(np.searchsorted(ends, ends[low] + limit, "right")) - 1
        high = min(max(high, low + 1), rows)
        yield low, high, raw[ends[low] : ends[high]], ends[low : high + 1] - ends[low]
        low = high


def small_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``SMALL_BATCH_ROWS`` rows, none of them empty."""
    for batch in batches:
        for low in range(0, batch.num_rows, SMALL_BATCH_ROWS):
            yield batch.slice(low, SMALL_BATCH_ROWS)


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive offsets; empty runs give 0."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]
