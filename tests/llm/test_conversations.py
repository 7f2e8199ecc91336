"""Repair of conversations against plain Python, on whole tables and on odd rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from odflow.llm import conversation_repair

SF = "/root/testdata/sf0.01"
SPACE = " \t\n\v\f\r"
EMPTY = hashlib.sha256(b"").hexdigest()


def damaged(rows):
    """Conversations after the damage, by plain Python."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        out[conv] += [] if fate == 0 else [(turn, role, text)] * (2 if fate == 3 else 1)
    for rows in out.values():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    return out


def marks(rows):
    seen, out = set(), []
    for _, role, text in rows:
        word = text.strip(SPACE)
        fault = "blank" if not word else "duplicate" if (role, text) in seen else ""
        if not fault and word[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(rows, faults):
    """All useful repairs, prefix by prefix: least cost, then least edits, per last role."""
    best = {"": (0, "", ())}

    def offer(table, state, entry):
        if state not in table or entry < table[state]:
            table[state] = entry

    def follow(state):
        return "a" if state == "u" else "u"

    names = {"u": "user", "a": "assistant"}

    def with_inserts(table):
        for _ in range(3):
            for state, (cost, edits, lines) in list(table.items()):
                offer(
                    table,
                    follow(state),
                    (cost + 5, edits + "I", (*lines, names[follow(state)] + ":")),
                )
        return table

    for (_, role, text), fault in zip(rows, faults, strict=True):
        after = {}
        for state, (cost, edits, lines) in with_inserts(best).items():
            offer(after, state, (cost + 2, edits + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault else 0
            nxt = follow(state)
            offer(after, nxt, (cost + 1 + more, edits + "R", (*lines, f"{names[nxt]}:{text}")))
            if role[:1] == nxt or role[:1] == "s" and state == "":
                offer(after, role[0], (cost + more, edits + "K", (*lines, f"{role}:{text}")))
        best = after
    best = with_inserts(best)
    cost, edits, lines = min(best[s] for s in ("", "a") if s in best)
    return cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def expected(rows):
    conversations = damaged(rows)
    out = {}
    for conv in {r[0] for r in rows}:
        own = conversations[conv]
        faults = marks(own)
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(own)]
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, *cheapest(own, faults))
    return out


def found(table):
    rows = conversation_repair.repair_conversations(table).collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r)[1:] for r in rows}


def frame(spark, rows):
    schema = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
    return spark.createDataFrame(rows, schema)


def test_repair_of_whole_table(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert found(table) == expected(rows)


def test_repair_of_odd_rows(spark):
    rng = random.Random(5)
    roles = ["user", "assistant", "system", None, "", "tool", "unit"]
    texts = ["Yes.", "No", None, "", " \t\n", "Hm?  ", "é!", "w " * 5000 + "."]
    rows = [
        (conv, turn if rng.random() > 0.05 else None, rng.choice(roles), rng.choice(texts))
        for conv in [*range(300), None]
        for turn in rng.sample(range(20), rng.randint(1, 9))
    ]
    # Rows of one turn have no order of their own: at most one null turn each.
    rows = list({(c, t): (c, t, r, x) for c, t, r, x in rows}.values())
    table = frame(spark, rows)
    wanted = expected(rows)
    assert found(table) == wanted
    names = ["part", "symbol", "initial", "tie", "copy", "dropped", "_nth", "fate", "gaps"]
    for name in names:
        table = table.selectExpr("*", f"'x' AS {name}")
    assert found(table.repartition(7)) == wanted


def test_repeated_rows_and_empty_table(spark):
    rows = [(3, 1, "user", "A."), (3, 1, "user", "A."), (3, 1, "user", "A.")]
    assert found(frame(spark, rows))[3][1:4] in {(0, 2, 0), (0, 5, 0)}
    assert found(frame(spark, rows).limit(0)) == {}
    # Checksums that drop every row of a conversation.
    lost = [c for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    rows = [(c, 0, "user", "A.") for c in lost[:2] for _ in range(2)]
    assert set(found(frame(spark, rows)).values()) == {(0, 0, 0, 0, 0, 0, "", EMPTY)}


def test_runs_and_powers():
    rng = random.Random(7)
    for _ in range(400):
        n = rng.randint(0, 9)
        symbols = "".join(rng.choice("suaoSUAObd") * rng.randint(1, 9) for _ in range(n))
        role = {"s": "system", "u": "user", "a": "assistant", "o": "other", "b": "x", "d": "x"}
        kinds = {"b": "blank", "d": "duplicate"}
        rows = [(0, role[s.lower()], f"{i}") for i, s in enumerate(symbols)]
        faults = [kinds.get(s, "truncated" if s.isupper() else "") for s in symbols]
        assert conversation_repair.repair(symbols) == cheapest(rows, faults)[:2], symbols
    # A run of many rows needs few products, and every choice is still unrolled.
    cost, edits = conversation_repair.repair("u" * 100_001)
    assert (cost, len(edits)) == (50_000 + 2, 100_001)


def test_one_long_conversation(spark):
    n = 20_000
    rows = [(1, t, "user" if t % 2 else "assistant", f"{t % 5000}." * 3) for t in range(n)]
    table = frame(spark, rows + [(2, 0, "user", "One.")])
    assert found(table) == expected(rows + [(2, 0, "user", "One.")])


@pytest.mark.parametrize("symbols", ["", "s", "u", "a", "ua", "sua", "UA", "bd"])
def test_smallest_repairs(symbols):
    wanted = {"": (0, ""), "s": (2, "D"), "u": (2, "D"), "a": (2, "D"), "ua": (0, "KK")}
    wanted |= {"sua": (0, "KKK"), "UA": (4, "DD"), "bd": (4, "DD")}
    assert conversation_repair.repair(symbols) == wanted[symbols]
