"""The Jaccard join against comparing all pairs, on tables, copies and odd rows."""

import random
import re

import numpy as np
import pytest

from odflow.llm import jaccard_join
from odflow.llm.jaccard_join import jaccard_components, scheme, signatures

SF = "/root/testdata/sf0.001"


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def shingles(text, n):
    w = words(text)
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def expected(rows, n=5, percent=80):
    """Rows of (id, text) by brute force over all pairs of distinct sets."""
    sets = [shingles(t, n) for _, t in rows]
    least = {}
    for (i, _), s in zip(rows, sets, strict=True):
        if s and i is not None:
            least[s] = min(i, least.get(s, i))
    keys = list(least)
    parent = {s: s for s in keys}

    def top(s):
        while parent[s] is not s:
            s = parent[s]
        return s

    for k, a in enumerate(keys):
        for b in keys[:k]:
            if 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    x, y = top(a), top(b)
                    if x is not y:
                        low, high = (x, y) if least[x] < least[y] else (y, x)
                        parent[high] = low
    return sorted(
        (
            -1 if i is None else i,
            len(s),
            -1 if i is None else least[top(s)] if s else i,
        )
        for (i, _), s in zip(rows, sets, strict=True)
    )


def found(table, **options):
    rows = jaccard_components(table, **options).collect()
    return sorted((-1 if a is None else a, n, -1 if c is None else c) for a, n, c in map(tuple, rows))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING")


def edited(rng, base, edits):
    out = list(base)
    for _ in range(edits):
        at = rng.randrange(len(out))
        what = rng.random()
        if what < 0.7:
            out[at] = f"e{rng.randrange(10**9)}"
        elif what < 0.85:
            out.insert(at, f"e{rng.randrange(10**9)}")
        elif len(out) > 1:
            del out[at]
    return " ".join(out)


def copies(rng, first_id, size, n, most):
    base = [f"w{rng.randrange(10**9)}" for _ in range(size)]
    texts = [" ".join(base), *(edited(rng, base, rng.randint(0, most)) for _ in range(n - 1))]
    return [(first_id + i, t) for i, t in enumerate(texts)]


def mixture(seed, scale=1):
    rng = random.Random(seed)
    rows = []
    for size in (1, 2, 4, 5, 6, 8, 9, 12, 16, 20, 30, 45, 70, 100, 130, 200, 400, 900):
        rows += copies(rng, len(rows), size, 12 * scale, max(1, size // 14))
    phrase = [f"p{i}" for i in range(25)]
    for _ in range(60):
        own = [f"x{rng.randrange(10**9)}" for _ in range(rng.randint(20, 150))]
        at = rng.randrange(len(own))
        rows.append((len(rows), " ".join(own[:at] + phrase + own[at:])))
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(order[i], text) for i, text in rows]


@pytest.mark.parametrize("shingle", [2, 5])
def test_whole_table(spark, shingle):
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in table.collect()]
    assert found(table, shingle=shingle) == expected(rows, shingle)


@pytest.mark.parametrize("shingle, percent", [(1, 80), (5, 80), (3, 60), (2, 100)])
def test_mixture_of_copies(spark, shingle, percent):
    rows = mixture(shingle)
    wanted = expected(rows, shingle, percent)
    assert found(frame(spark, rows), shingle=shingle, percent=percent) == wanted


def test_sets_that_lack_segments(spark, monkeypatch):
    """With far too few segments, sets are found through single elements."""
    monkeypatch.setattr(jaccard_join, "LACKING", 1e300)
    monkeypatch.setattr(jaccard_join, "FILLED", 0.3)
    scheme.cache_clear()
    try:
        rows = mixture(3)
        sizes = np.array([len(shingles(t, 2)) for _, t in rows])
        rng = np.random.default_rng(1)
        sets = [np.sort(rng.integers(0, 2**64, n, np.uint64)) for n in sizes]
        first = np.concatenate([[0], np.cumsum(sizes)])
        assert len(signatures(np.concatenate(sets), first, 80)[2]) > 0
        assert found(frame(spark, rows), shingle=2) == expected(rows, 2)
    finally:
        scheme.cache_clear()


def test_signatures_meet():
    """Linked sets share a key that the larger one probes, whatever their sizes."""
    rng = np.random.default_rng(4)
    lacking = 0
    for size in [*range(1, 60), 90, 116, 117, 150, 400, 1200]:
        for _ in range(20):
            a = rng.integers(0, 2**64, size, np.uint64)
            most = int(0.2 * size / 0.8) if size > 3 else 0
            gone = rng.integers(0, size // 5 + 1) if size > 3 else 0
            added = rng.integers(0, most + 1)
            b = np.concatenate([a[gone:], rng.integers(0, 2**64, added, np.uint64)])
            both = size - gone
            if 100 * both < 80 * (size + added) or gone == added == 0:
                continue
            pair = [np.sort(x) for x in (a, b)]
            first = np.array([0, len(a), len(a) + len(b)])
            keys, owners, few = signatures(np.concatenate(pair), first, 80)
            lacking += len(few)
            groups = [set((keys[owners == i] >> np.uint64(1)).tolist()) for i in (0, 1)]
            larger = int(len(b) >= len(a))
            probed = keys[(owners == larger) & (keys & np.uint64(1) == 1)] >> np.uint64(1)
            equal_sizes = len(a) == len(b)
            assert set(probed.tolist()) & groups[1 - larger] or equal_sizes and groups[0] & groups[1]
    assert lacking == 0


def test_one_group_of_many_copies(spark):
    rng = random.Random(11)
    rows = copies(rng, 0, 150, 600, 12)
    assert found(frame(spark, rows)) == expected(rows)


def test_odd_rows(spark, docs, none):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(docs) == expected(rows)
    assert found(none) == []
    named = docs
    for name in ("id", "hub", "key", "n", "part", "members", "set_id", "a", "b", "node", "_doc"):
        named = named.selectExpr("*", f"'x' AS {name}")
    assert found(named.repartition(5)) == expected(rows)
    with pytest.raises(ValueError):
        jaccard_components(docs, percent=50)


def test_shared_keys_are_written_once(spark, monkeypatch):
    """Copies of two linked texts: each key and set is one row of the table."""
    words = [f"k{i}" for i in range(60)]
    texts = [" ".join(words), " ".join(words[:-1])]
    rows = [(i, texts[i % 2]) for i in range(40)]
    write, tables = jaccard_join.materialize, {}

    def kept(df, label):
        tables[label] = write(df, label)
        return tables[label]

    monkeypatch.setattr(jaccard_join, "materialize", kept)
    table = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    found = jaccard_join.jaccard_components(table).collect()
    assert {r["component_id"] for r in found} == {0}
    keys = tables["shared-keys"]
    assert 0 < keys.count() == keys.distinct().count()
