"""Damaged conversations, their faults and their cheapest repair.

A conversation is in order if its roles read ``(s?(ua)+)?``: an optional system turn,
then user and assistant in turn. Edits are Keep, Rerole, Delete and Insert. The state of
a repair is what stands last (nothing, s, u or a), so one row is a 4 x 4 matrix over
(min, +), and a run of equal rows is a power of it. Binary powers are cached: a run of n
rows takes log n products. The edits themselves are unrolled afterwards, run by run, by
halves, whose costs come from the same powers.

A task reads its conversations as a stream in order: first one symbol per row, then, for
the hash of the repaired text, the rows once more. So it holds one byte per row and 32
bytes per run of the conversation at hand, never its texts, however long it is.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]"
RESULT = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "cost bigint, audit string, repaired_sha256 string"
)

# What stands last in the repaired conversation.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
DELETE, INSERT, REROLE, CUT_OFF = 2, 5, 1, 5
NEVER = 1 << 60

Matrix = tuple[tuple[int, ...], ...]


def damage(turns: DataFrame) -> DataFrame:
    """Rows with ``dropped`` and ``copy``, damaged by the checksum of ``conv_id:turn``.

    Of 20 remainders, 0 drops a row (it stays, marked), 1 empties its text, 2 takes its
    ``.!?``, 3 repeats it, 4 makes it a user's. Nulls count as one space.
    """
    space = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), space),
    )
    fate = F.crc32(key) % 20
    text = F.coalesce("text", space)
    return turns.select(
        "conv_id",
        "turn",
        F.when(fate == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(fate == 1, "")
        .when(fate == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text)
        .alias("text"),
        (fate == 0).alias("dropped"),
        F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` with ``tie`` and ``symbol``: the first letter of the role and the fault.

    ``d`` is a row that has to go, blank or seen before; ``b`` tells the blank ones
    from it. A capital is a truncated row. ``o`` is any other role.
    """
    rows = rows.withColumn("tie", F.xxhash64("role", "text"))
    # The same role and text share the group, so a long conversation is many groups.
    seen = Window.partitionBy("conv_id", "tie", "dropped", "role", "text").orderBy(
        F.asc_nulls_first("turn"), "copy"
    )
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    ended = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    return rows.withColumn("_nth", F.row_number().over(seen)).select(
        *rows.columns,
        initial.alias("initial"),
        F.when(F.col("dropped"), None)
        .when(~F.col("text").rlike(WORD), "b")
        .when(F.col("_nth") > 1, "d")
        .when(ended, known)
        .otherwise(F.upper(known))
        .alias("symbol"),
    )


def product(a: Matrix, b: Matrix) -> Matrix:
    """The product over (min, +)."""
    columns = list(zip(*b, strict=True))
    return tuple(
        tuple(min(x + y for x, y in zip(row, column, strict=True)) for column in columns)
        for row in a
    )


def _matrix(costs: dict[tuple[int, int], int]) -> Matrix:
    return tuple(tuple(costs.get((p, q), NEVER) for q in range(4)) for p in range(4))


def _next_turn(state: int) -> int:
    """The state behind the only turn of a user or an assistant that may follow."""
    return ASSISTANT if state == USER else USER


_INSERT = _matrix(
    {(p, p): 0 for p in range(4)} | {(p, _next_turn(p)): INSERT for p in range(4)}
)
# At most two inserted turns in a row: more come back to where they began.
INSERTS = product(_INSERT, _INSERT)


def keep(symbol: str, state: int) -> int | None:
    """The state after keeping a row, None if it may not be kept."""
    role = symbol.lower()
    if role == "s":
        return SYSTEM if state == NOTHING else None
    after = _next_turn(state)
    return after if role == ("a" if after == ASSISTANT else "u") else None


@lru_cache(maxsize=None)
def power(symbol: str, bit: int) -> Matrix:
    """Cheapest costs over ``2 ** bit`` rows of one symbol, inserts before each."""
    if bit:
        half = power(symbol, bit - 1)
        return product(half, half)
    costs = {(p, p): DELETE for p in range(4)}
    if symbol not in "bd":
        extra = CUT_OFF if symbol.isupper() else 0
        for p in range(4):
            options = [(_next_turn(p), REROLE + extra)]
            if (kept := keep(symbol, p)) is not None:
                options.append((kept, extra))
            for q, cost in options:
                costs[p, q] = min(cost, costs.get((p, q), NEVER))
    return product(INSERTS, _matrix(costs))


def to_go(symbol: str, n: int, rest: tuple[int, ...]) -> tuple[int, ...]:
    """Cost by state before ``n`` rows of a symbol, from the cost ``rest`` behind them."""
    bit = 0
    while n:
        if n & 1:
            rest = tuple(
                min(x + y for x, y in zip(row, rest, strict=True)) for row in power(symbol, bit)
            )
        n >>= 1
        bit += 1
    return rest


END = tuple(min(row[NOTHING], row[ASSISTANT]) for row in INSERTS)


class _Unroll:
    """Writes the edits of a conversation, at every choice the least letter that is cheapest."""

    def __init__(self) -> None:
        self.state, self.edits = NOTHING, bytearray()

    def rows(self, symbol: str, n: int, rest: tuple[int, ...]) -> None:
        if n == 1:
            self.row(symbol, rest)
        else:
            self.rows(symbol, n - n // 2, to_go(symbol, n // 2, rest))
            self.rows(symbol, n // 2, rest)

    def row(self, symbol: str, rest: tuple[int, ...]) -> None:
        before = to_go(symbol, 1, rest)
        extra = CUT_OFF if symbol.isupper() else 0
        while True:
            left, after = before[self.state], _next_turn(self.state)
            if left == DELETE + rest[self.state]:
                self.edits += b"D"
                return
            if left == INSERT + before[after]:
                self.edits += b"I"
                self.state = after
                continue
            kept = keep(symbol, self.state)
            if kept is not None and left == extra + rest[kept]:
                self.edits += b"K"
                self.state = kept
            else:
                self.edits += b"R"
                self.state = after
            return

    def end(self) -> None:
        while self.state not in (NOTHING, ASSISTANT):
            self.edits += b"I"
            self.state = _next_turn(self.state)


def repair(symbols: str) -> tuple[int, str]:
    """Cost and edits of the cheapest repair; of several, the edits least in ASCII."""
    runs = [(symbol, sum(1 for _ in run)) for symbol, run in groupby(symbols)]
    behind = array("q")  # cost by state behind each run, the last run first
    rest = END
    for symbol, n in reversed(runs):
        behind.extend(rest)
        rest = to_go(symbol, n, rest)
    unroll = _Unroll()
    for i, (symbol, n) in enumerate(runs):
        at = 4 * (len(runs) - 1 - i)
        unroll.rows(symbol, n, tuple(behind[at : at + 4]))
    unroll.end()
    return rest[NOTHING], unroll.edits.decode()


# Conversations of few rows repeat their symbols.
_repair_short = lru_cache(maxsize=1 << 16)(repair)


class _Conversation:
    """Counts of one conversation, and the hash of its repair, row by row."""

    def __init__(self, conv_id) -> None:
        self.conv_id = conv_id
        self.symbols = bytearray()
        self.first = self.last = None
        self.turns = self.illegal = 0
        self.initial = None
        self.cost, self.edits, self.at = 0, None, 0
        self.state, self.hash, self.lines = NOTHING, hashlib.sha256(), 0

    def add(self, turn: int | None, symbol: str | None, initial: str) -> None:
        if symbol is None:
            return
        if turn is not None and turn != self.last:
            self.turns += 1
            self.first = turn if self.first is None else self.first
            self.last = turn
        if self.symbols and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        self.symbols += symbol.encode()

    def settle(self) -> None:
        symbols = self.symbols.decode()
        self.cost, self.edits = (_repair_short if len(symbols) <= 32 else repair)(symbols)

    def write(self, role: str, text: str) -> None:
        if self.lines:
            self.hash.update(b"\n")
        self.hash.update(f"{role}:{text}".encode())
        self.lines += 1

    def _turn(self, text: str) -> None:
        self.state = _next_turn(self.state)
        self.write("assistant" if self.state == ASSISTANT else "user", text)

    def inserts(self) -> None:
        while self.edits[self.at : self.at + 1] == "I":
            self._turn("")
            self.at += 1

    def line(self, role: str, text: str) -> None:
        if self.edits is None:
            self.settle()
        self.inserts()
        edit = self.edits[self.at]
        self.at += 1
        if edit == "K":
            self.state = SYSTEM if role[:1] == "s" else _next_turn(self.state)
            self.write(role, text)
        elif edit == "R":
            self._turn(text)

    def result(self) -> tuple:
        if self.edits is None:
            self.settle()
        self.inserts()
        count = self.symbols.count
        truncated = sum(count(c) for c in b"SUAO")
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        counts = gaps, count(b"b"), count(b"d"), truncated, self.illegal, self.cost
        return self.conv_id, *counts, self.edits, self.hash.hexdigest()


def _repaired(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """One row per conversation from rows in the order of conversation, part and turn."""
    names = ["conv_id", *(c.split()[0] for c in RESULT.split(", "))]
    types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
        )

    now: _Conversation | None = None
    for batch in batches:
        done = []
        for conv_id, part, turn, symbol, initial, role, text in zip(
            *(column.to_pylist() for column in batch.columns), strict=True
        ):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    done.append(now.result())
                now = _Conversation(conv_id)
            if part == 0:
                now.add(turn, symbol, initial)
            else:
                now.line(role, text)
        if done:
            yield batch_of(done)
    if now is not None:
        yield batch_of([now.result()])


def repair_conversations(turns: DataFrame) -> DataFrame:
    """Faults and cheapest repair of every conversation after :func:`damage`.

    One row per ``conv_id``, also of those that lose all rows (zeros, no edits, the hash
    of an empty string). Rows go by turn, null first; rows of one turn by a hash of role
    and text, repeated ones side by side. A null ``conv_id`` is a conversation of its
    own. Empty texts are blank. Repeated rows are duplicates. No rows give no rows. Other
    columns are ignored, whatever their names.
    """
    rows = faults(damage(turns.select("conv_id", "turn", "role", "text")))
    none = F.lit(None).cast("string")
    symbols = F.struct(F.lit(0).alias("part"), "symbol", "initial", none.alias("role"), none.alias("text"))
    lines = F.struct(F.lit(1).alias("part"), none.alias("symbol"), none.alias("initial"), "role", "text")
    both = F.when(F.col("dropped"), F.array(symbols)).otherwise(F.array(symbols, lines))
    order = ["conv_id", "part", F.asc_nulls_first("turn"), "tie", "copy"]
    stream = (
        rows.select("conv_id", "turn", "tie", "copy", F.inline(both))
        .repartition("conv_id")
        .sortWithinPartitions(*order)
        .select("conv_id", "part", "turn", "symbol", "initial", "role", "text")
    )
    field = turns.schema["conv_id"].dataType
    kind = pa.int64() if field.simpleString() == "bigint" else pa.string()
    if kind == pa.string():
        stream = stream.withColumn("conv_id", F.col("conv_id").cast("string"))
    repaired = stream.mapInArrow(
        lambda batches: _repaired(batches, kind),
        f"conv_id {'bigint' if kind == pa.int64() else 'string'}, {RESULT}",
    )
    return repaired.withColumn("conv_id", F.col("conv_id").cast(field))
