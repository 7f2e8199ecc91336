"""The prefix trie against plain Python, over blocks of several sizes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from odflow.llm.prefix_trie import NODE, prefix_trie

SF = "/root/testdata/sf0.01"


def sha(members):
    return hashlib.sha256(",".join(map(str, sorted(members))).encode()).hexdigest()


def expected(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(v)] for c, v in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members, leaves, saved, children = (defaultdict(list) for _ in range(4))
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    for path, m in members.items():
        words = len(path[-1][1].encode().split()) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]].append(path not in children)
            saved[path[:d]].append((len(m) - 1) * words)
    return sorted(
        (
            min(m),
            len(path),
            min(members[path[:-1]]) if path else -1,
            len(m),
            len(children[path]) if path in children else 0,
            sum(leaves[path]),
            sum(saved[path]),
            sha([c for c in m if paths[c] == path]),
        )
        for path, m in members.items()
    )


def found(table, **options):
    rows = prefix_trie(table, **options).select(*NODE, "ends_sha256").collect()
    return sorted((*r[:2], -1 if r[2] is None else r[2], *r[3:]) for r in map(tuple, rows))


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")


def test_trie_of_whole_table(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    wanted = expected(rows)
    assert found(table) == wanted
    assert found(table, block=3) == wanted


def few_turns(seed):
    rng = random.Random(seed)
    rows = []
    for conv in [*rng.sample(range(200), 120), None]:
        for turn in rng.sample(range(30), rng.randint(1, 12)):
            role = rng.choice(["user", "assistant", None])
            text = rng.choice(["a b", "a b", "a b", "c", None, "", " \t", "é ü ß"])
            rows.append((conv, turn if turn else None, role, text))
    return rows


@pytest.mark.parametrize("block", [1, 2, 8])
def test_shared_prefixes_in_blocks(spark, block):
    rows = few_turns(block)
    # Copies: conversations with the same turns, long and short ones.
    rows += [(c, t, "user", f"line {t}") for c in (300, 320, 340, 361) for t in range(15)]
    rows += [(c, t, "user", f"line {t}") for c in (380, 401) for t in range(6)]
    assert found(frame(spark, rows), block=block) == expected(rows)


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, None, None, None), (2, 1, "", ""), (2, 1, "user", "x")]
    rows += [(7, 0, "user", "w " * 30_000), (27, 0, "user", "w " * 30_000)]
    # A conversation whose only turns are replaced by an absent donor's has none left.
    bare = next(c for c in range(101, 120) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows += [(bare, 0, "user", "gone"), (bare, 1, "user", "gone too")]
    table = frame(spark, rows)
    wanted = expected(rows)
    # It ends in the root.
    assert next(w for w in wanted if w[1] == 0)[7] == sha([1, bare])
    assert found(table) == wanted
    for name in ("prior", "t1", "w1", "level", "block", "pos", "one", "set", "_node", "_slice"):
        table = table.selectExpr("*", f"'x' AS {name}")
    assert found(table, block=2) == wanted
    assert found(table.limit(0)) == []


def test_one_conversation_with_most_rows(spark):
    rows = [(40, t, "user", f"turn {t}") for t in range(3000)]
    rows += [(41 + i, t, "user", f"turn {t}") for i in range(12) for t in range(10 + i)]
    assert found(frame(spark, rows)) == expected(rows)
