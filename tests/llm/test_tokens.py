"""Token counts and packing against the tokenizer library."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from odflow.llm import packing, token_counts
from odflow.llm.queries import vocabulary
from odflow.llm.text import text_slices
from odflow.llm.transducer import tokenizer

LIBRARY = Tokenizer.from_file(vocabulary())


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def random_texts():
    rng = random.Random(3)
    letters = "abAB st're ve ll 'd'm!?.,  \n\t\r éñü漢字123٣½²​😀''_-\x00\x1f　"
    texts = ["", "'re", "'r", "we'rE we're", "  'll  'l", " \n\n a", "<|endoftext|>"]
    texts += ["x<|endoftext|>", "<|endoftext|><|endoftext|>  a", "a" * 2000, "!" * 1500, " " * 900]
    for _ in range(600):
        texts.append("".join(rng.choice(letters) for _ in range(rng.randint(0, 40))))
    for _ in range(100):
        points = (rng.choice([rng.randint(1, 0xD7FF), rng.randint(0xE000, 0x10FFFF)]) for _ in range(20))
        texts.append("".join(map(chr, points)))
    return texts


def test_transducers_equal_the_library():
    texts = random_texts()
    machine = tokenizer(vocabulary())
    for limit in (300, 1 << 20):
        counts, ids = [], []
        for low, high, data, offsets in text_slices(pa.array(texts), limit):
            counts += machine.counts(data, offsets).tolist()
            flat, first = machine.ids(data, offsets)
            ids += [flat[first[i] : first[i + 1]].tolist() for i in range(high - low)]
        assert ids == [library_ids(t) for t in texts]
        assert counts == [len(i) for i in ids]


def test_full_piece_table_only_costs_time(monkeypatch):
    from odflow.llm import transducer

    monkeypatch.setattr(transducer, "MAX_PIECES", 64)
    machine = transducer.Tokenizer(vocabulary())
    for _, _, data, offsets in text_slices(pa.array(["ab cd ef " * 20, "gh ij kl mn"]), 10):
        machine.counts(data, offsets)
    texts = [f"word{i} other{i}" for i in range(200)]
    got = []
    for _, _, data, offsets in text_slices(pa.array(texts), 60):
        got += machine.counts(data, offsets).tolist()
    assert got == [len(library_ids(t)) for t in texts]


def test_text_with_more_pieces_than_the_table(monkeypatch):
    from odflow.llm import transducer

    monkeypatch.setattr(transducer, "MAX_PIECES", 64)
    monkeypatch.setattr(transducer, "MAX_PAIRS", 64)
    machine = transducer.Tokenizer(vocabulary())
    texts = ["ab cd", " ".join(f"id{i * 7919}x" for i in range(900)), "ab cd ef", " ".join(map(str, range(500)))]
    for text in texts * 2:
        (part,) = text_slices(pa.array([text]))
        assert machine.counts(*part[2:]).tolist() == [len(library_ids(text))]
        assert machine.ids(*part[2:])[0].tolist() == library_ids(text)


def test_token_counts(docs, none):
    rows = token_counts.token_counts(docs, vocabulary()).collect()
    source = docs.collect()
    assert len(rows) == len(source)
    expected = sorted(
        (r["doc_id"] is None, r["doc_id"] or 0, len((r["text"] or "").encode()), len(library_ids(r["text"])))
        for r in source
    )
    assert expected == sorted(
        (r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in rows
    )
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in rows)
    assert token_counts.token_counts(none, vocabulary()).collect() == []


def check_packing(rows, texts, size):
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for doc, text in texts.items():
        ids = np.array([*library_ids(text), 2], "<u4")
        pieces = sorted(by_doc[doc], key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces)))
        assert sum(r["length"] for r in pieces) == len(ids)
        assert all(r["length"] == size for r in pieces[1:])
        for r in pieces:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
    ends = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= size


@pytest.mark.parametrize("size", [16, 1024])
def test_pack(docs, size):
    unique = docs.dropDuplicates(["doc_id"])
    rows = packing.pack(unique, vocabulary(), size=size, rounds=20).collect()
    check_packing(rows, {r["doc_id"]: r["text"] for r in unique.collect()}, size)


def test_pack_repeated_rows_and_no_rows(docs, none):
    rows = packing.pack(docs, vocabulary(), rounds=5).collect()
    assert sum(r["doc_id"] == 2 for r in rows) == 2 * len({r["piece"] for r in rows if r["doc_id"] == 2})
    assert packing.pack(none, vocabulary()).collect() == []


def test_plan_holds_the_stock_and_is_near_the_bound():
    rng = np.random.default_rng(1)
    for size, n in ((64, 3000), (1024, 20000)):
        lengths, counts = np.unique(rng.integers(1, size + 1, n), return_counts=True)
        stock = dict(zip(lengths.tolist(), counts.tolist(), strict=True))
        plan = packing.plan_packing(stock, size, rounds=100)
        held = {}
        for config, times in plan:
            assert sum(k * c for k, c in config.items()) <= size
            for k, c in config.items():
                held[k] = held.get(k, 0) + c * times
        assert held == stock
        bound = sum(k * c for k, c in stock.items()) / size
        assert sum(t for _, t in plan) <= bound * 1.02 + 1
    assert packing.plan_packing({}, 16) == []


def test_knapsack_is_optimal():
    rng = np.random.default_rng(2)
    for _ in range(20):
        lengths = np.unique(rng.integers(1, 13, 5))
        values = rng.random(len(lengths))
        best = np.zeros(21)
        for room in range(1, 21):
            fits = [v + best[room - k] for k, v in zip(lengths, values, strict=True) if k <= room]
            best[room] = max([best[room - 1], *fits])
        config = packing._knapsack(lengths, values, 20)
        worth = sum(values[list(lengths).index(k)] * c for k, c in config.items())
        assert abs(worth - best[20]) < 1e-9
