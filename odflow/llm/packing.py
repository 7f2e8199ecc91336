"""Packing tokenized documents into sequences of fixed length.

The number of pieces of each length is all that matters for the packing: at most
``size`` numbers, whatever the number of documents. A linear program over
configurations (multisets of lengths that fit a sequence) is solved on them by
multiplicative weights: a length that is covered little weighs much, and a knapsack
over the weights gives the next configuration. The solution is rounded down, what is
left is packed by best fit, and whole lengths of the plan are dealt to the pieces by
their rank within their length, on Spark.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflow.llm.running import running_total
from odflow.llm.text import text_slices
from odflow.llm.transducer import tokenizer
from odflow.sources.scratch import materialize

ROUNDS = 600

Config = dict[int, int]  # copies by length


def best_fit(stock: dict[int, int], size: int) -> list[tuple[Config, int]]:
    """Best-fit decreasing on numbers of pieces by length: ``(config, sequences)``.

    Sequences filled alike are handled as one group.
    """
    groups: dict[int, list[tuple[Config, int]]] = {}
    room_left: list[int] = []  # sorted free rooms that have a group

    def add(free: int, config: Config, n: int) -> None:
        if free not in groups:
            groups[free] = []
            room_left.insert(int(np.searchsorted(room_left, free)), free)
        groups[free].append((config, n))

    for length in sorted((k for k, n in stock.items() if n), reverse=True):
        left = stock[length]
        while left:
            i = int(np.searchsorted(room_left, length))
            if i == len(room_left):
                fit = size // length
                if left >= fit:
                    add(size - fit * length, {length: fit}, left // fit)
                if left % fit:
                    add(size - left % fit * length, {length: left % fit}, 1)
                break
            free = room_left[i]
            config, n = groups[free].pop()
            if not groups[free]:
                del groups[free]
                room_left.pop(i)
            used = min(n, left)
            if n > used:
                add(free, config, n - used)
            add(free - length, {**config, length: config.get(length, 0) + 1}, used)
            left -= used
    return [g for room in groups.values() for g in room]


def _knapsack(lengths: np.ndarray, values: np.ndarray, size: int) -> Config:
    """The multiset of lengths of the largest value that fits."""
    by_length = np.full(size + 1, -1.0)
    by_length[lengths] = values
    best = np.zeros(size + 1)
    pick = np.zeros(size + 1, np.int64)
    flipped = by_length[::-1].copy()
    for room in range(1, size + 1):
        # best[room - l] + value of l, for l = room .. 1
        total = best[:room] + flipped[size - room : size]
        i = int(total.argmax())
        if total[i] > best[room - 1]:
            best[room], pick[room] = total[i], room - i
        else:
            best[room] = best[room - 1]
    config: Config = {}
    room = size
    while room > 0:
        length = int(pick[room])
        if length:
            config[length] = config.get(length, 0) + 1
        room -= length or 1
    return config


def configuration_lp(
    stock: dict[int, int], size: int, rounds: int = ROUNDS
) -> list[tuple[Config, float]]:
    """``(config, number)`` that cover the stock fractionally, about least in number."""
    lengths = np.array(sorted(k for k, n in stock.items() if n), np.int64)
    if not len(lengths):
        return []
    need = np.array([stock[int(k)] for k in lengths], float)
    place = {int(k): i for i, k in enumerate(lengths)}
    covered = np.zeros(len(lengths))
    chosen: dict[tuple, float] = {}
    rate = 2.0 * np.log(len(lengths) + 1.0)
    for _ in range(rounds):
        weight = np.exp(-rate * (covered - covered.min()))
        config = _knapsack(lengths, weight / need, size)
        step = min(need[place[k]] / c for k, c in config.items())
        key = tuple(sorted(config.items()))
        chosen[key] = chosen.get(key, 0.0) + step
        for k, c in config.items():
            covered[place[k]] += step * c / need[place[k]]
    scale = max(float((covered * need).sum() / need.sum()), 1.0)
    return [(dict(key), x / scale) for key, x in chosen.items()]


def plan_packing(
    stock: dict[int, int], size: int, rounds: int = ROUNDS
) -> list[tuple[Config, int]]:
    """``(config, sequences)`` that hold the stock exactly.

    The linear program's solution rounded down, never beyond what is there, and best
    fit for the rest; or best fit for all, if that takes no more sequences.
    """
    left = dict(stock)
    plan = []
    if left.get(size):
        plan.append(({size: 1}, left.pop(size)))
    plain = best_fit(left, size)
    rounded = []
    for config, x in sorted(
        configuration_lp(left, size, rounds),
        key=lambda c: -sum(k * n for k, n in c[0].items()),
    ):
        n = min([int(x), *(left[k] // c for k, c in config.items())])
        if n:
            rounded.append((config, n))
            for k, c in config.items():
                left[k] -= n * c
    rounded += best_fit(left, size)
    count = lambda p: sum(n for _, n in p)
    return plan + (rounded if count(rounded) < count(plain) else plain)


class Slots:
    """Where the pieces of each length go, by their rank within the length."""

    def __init__(self, plan: list[tuple[Config, int]]) -> None:
        rows, taken, sequence = [], {}, 0
        for config, n in plan:
            offset = 0
            for length, copies in sorted(config.items(), reverse=True):
                first = taken.get(length, 0)
                rows.append((length << 44 | first, sequence, copies, offset))
                taken[length] = first + n * copies
                offset += length * copies
            sequence += n
        table = np.array(sorted(rows), np.int64).reshape(-1, 4)
        self.key, self.sequence, self.copies, self.offset = table.T.copy()

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.searchsorted(self.key, length << 44 | rank, "right") - 1
        inside = rank - (self.key[row] & ((1 << 44) - 1))
        return (
            self.sequence[row] + inside // self.copies[row],
            self.offset[row] + inside % self.copies[row] * length,
        )


def tokenized_pieces(
    docs: DataFrame, path: str, size: int, end_id: int, id_col: str, text_col: str
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``; no shuffle."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = tokenizer(path)
        for batch in batches:
            for low, _, data, offsets in text_slices(batch.column(1)):
                ids, first = machine.ids(data, offsets)
                ids = np.insert(ids, first[1:], end_id).astype("<u4")
                first = first + np.arange(len(first))
                total = np.diff(first)
                n = -(-total // size)
                doc = np.repeat(np.arange(len(n)), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                short = (total - 1) % size + 1  # length of the first piece
                start = np.where(piece > 0, short[doc] + (piece - 1) * size, 0)
                length = np.where(piece > 0, size, short[doc])
                at = (first[doc] + start).tolist()
                sums = [
                    zlib.crc32(ids[i : i + k].tobytes())
                    for i, k in zip(at, length.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(low + doc)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(start),
                        pa.array(length),
                        pa.array(sums, pa.int64()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        cut,
        f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint",
    )


def pack(
    docs: DataFrame,
    path: str,
    size: int = 1024,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = ROUNDS,
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` by piece.

    A document is its ids and ``end_id``. Only documents longer than ``size`` are cut:
    the first piece takes what is left over, the others are full. Every token is in
    exactly one sequence, and a sequence has no gaps but at its end. A null or empty
    text is one piece of one token. Rows that repeat are packed as often as they stand
    there. No rows give no pieces.
    """
    pieces = materialize(
        tokenized_pieces(docs, path, size, end_id, id_col, text_col), "pieces"
    )
    histogram = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
    slots = Slots(plan_packing({r["length"]: r["n"] for r in histogram}, size, rounds))
    ranked = running_total(
        pieces.withColumn("_one", F.lit(1)),
        ["doc_id", "piece", "start", "ids_crc32"],
        "_one",
        "_rank",
        group=["length"],
    ).drop("_one")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (
                batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank")
            )
            sequence, offset = slots.place(length, rank - 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                [*batch.schema.names[:5], "sequence_id", "offset"],
            )

    kind = pieces.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(
        deal,
        f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
        "sequence_id bigint, offset bigint",
    )
