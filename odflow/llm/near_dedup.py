"""Near-duplicate documents by HyperMinHash registers, confirmed on full sets.

A text's set are its distinct shingles. Shingles are dealt into buckets by hash; of
the smallest value in a bucket a register keeps the number of leading zeros and a few
mantissa bits. The register of an empty bucket takes the smallest value of all shingles
under a hash of its own. Bands of registers find candidates; a band is wide enough that
a passage which many texts share does not bring them together; the share of equal registers,
corrected for registers that agree by chance, drops candidates that are far off; the
rest is confirmed on the full sets of hashes.

Equal sets form a class first, and only one document of a class goes on. Members of a
band are compared with one of them, its hub. What that leaves open is
settled without comparing all pairs of the band:

* The Jaccard distance is a metric. With links up to distance d, a text beyond 2 d of
  the hub has no link to a text linked to the hub.
* Texts within 2 d of the hub, but not in its component, are joined with the others there
  on their rarest differences from the hub (``hub_pairs``). Two texts with a link share
  more than a certain number of differences, so that a prefix of them is enough.
* Texts beyond 2 d of the hub, which a band seldom has, are compared with those of the
  band that are not linked to the hub.

No link between different texts is lost by this.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflow.llm.components import components
from odflow.llm.hub_pairs import difference_rows, pairs_by_differences
from odflow.llm.names import fresh
from odflow.llm.text import (
    LOWER,
    SMALL_SLICE_BYTES,
    mix64,
    small_batches,
    split_words,
    text_slices,
)
from odflow.sources.scratch import materialize, settle

BUCKETS = 128
BANDS = 64
BAND = 6
MANTISSA_BITS = 10
SIGMAS = 6.0

_BITS = BUCKETS.bit_length() - 1
_SALT = mix64(np.arange(1, BUCKETS + 1, dtype=np.uint64))
_ODD = mix64(_SALT) | np.uint64(1)
# The registers of each band: random ones, a register serves several bands.
_SUBSETS = np.stack(
    [np.random.default_rng(i).choice(BUCKETS, BAND, replace=False) for i in range(BANDS)]
)


def shingle_sets(
    data: np.ndarray, offsets: np.ndarray, n: int
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes in rising order by text, and their offsets."""
    hashes, first = split_words(LOWER[data], offsets).shingles(n)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.argsort(hashes)
    narrow = np.uint16 if len(first) < 1 << 16 else np.uint32
    order = order[np.argsort(doc[order].astype(narrow), kind="stable")]
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    counts = np.bincount(doc[new], minlength=len(first) - 1)
    return hashes[new], np.concatenate([[0], np.cumsum(counts)])


def registers(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One row of registers per text, all 0 for an empty set."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    slot = doc * BUCKETS + (hashes >> np.uint64(64 - _BITS)).astype(np.int64)
    lowest = np.ones(len(slot), bool)
    lowest[1:] = slot[1:] != slot[:-1]
    smallest = np.zeros((len(first) - 1) * BUCKETS, np.uint64)
    smallest[slot[lowest]] = hashes[lowest] << np.uint64(_BITS) | np.uint64(1)
    smallest = smallest.reshape(-1, BUCKETS)
    empty = smallest == 0
    for i in np.flatnonzero(empty.any(1) & (np.diff(first) > 0)).tolist():
        own, bare = hashes[first[i] : first[i + 1]], empty[i]
        with np.errstate(over="ignore"):
            other = (own[:, None] ^ _SALT[bare]) * _ODD[bare]
        smallest[i, bare] = other.min(0) | np.uint64(1)
    # A float's exponent counts the leading zeros, and its mantissa begins behind them.
    packed = smallest.astype(np.float64).view(np.uint64) >> np.uint64(52 - MANTISSA_BITS)
    exponent = np.uint64(1023 + 64) - (packed >> np.uint64(MANTISSA_BITS))
    mantissa = packed & np.uint64((1 << MANTISSA_BITS) - 1)
    exponent = np.minimum(exponent, np.uint64(62))
    out = (exponent << np.uint64(MANTISSA_BITS) | mantissa) + np.uint64(1)
    out[smallest == 0] = 0
    return out.astype(np.uint16)


def jaccard_estimate(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated similarity by rows of registers, and the registers it rests on.

    Two different values share a register of lz zeros and m mantissa bits with
    probability 2**-(lz + m) about; the expected number of such collisions, taken at
    the registers seen, is subtracted.
    """
    used = (a > 0) | (b > 0)
    n = used.sum(1)
    equal = ((a == b) & used).sum(1)
    zeros = np.minimum(a, b).astype(np.int64) - 1 >> MANTISSA_BITS
    chance = np.where((a > 0) & (b > 0), 0.5 ** (np.maximum(zeros, 0) + MANTISSA_BITS), 0)
    expected = chance.sum(1)
    share = (equal - expected) / np.maximum(n - expected, 1)
    return share, n


def register_bits(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One bit per register, in two 64-bit numbers."""
    bits = mix64(rows.astype(np.uint64)) >> np.uint64(63)
    packed = np.packbits(bits.astype(np.uint8), axis=1).view(np.int64)
    return packed[:, 0], packed[:, 1]


def may_reach(percent: int) -> Column:
    """Bits of the rows x and y differ no more often than those of links do.

    Registers that differ have different bits half of the time. The margin is six
    standard deviations.
    """
    share = (1 - percent / 100) / 2
    most = BUCKETS * share + SIGMAS * (BUCKETS * share * (1 - share)) ** 0.5
    apart = [F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in ("bits_a", "bits_b")]
    return apart[0] + apart[1] <= int(most)


def _signatures(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, data, offsets in text_slices(batch.column(1), SMALL_SLICE_BYTES):
            hashes, first = shingle_sets(data, offsets, n)
            with np.errstate(over="ignore"):
                sums = [
                    np.concatenate([[np.uint64(0)], np.cumsum(mix64(hashes ^ np.uint64(s)))])
                    for s in (1, 2)
                ]
                keys = [(s[first[1:]] - s[first[:-1]]).view(np.int64) for s in sums]
            rows = registers(hashes, first)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(low, high - low),
                    pa.array(np.diff(first)),
                    pa.array(keys[0]),
                    pa.array(keys[1]),
                    pa.array([r.tobytes() for r in rows], pa.binary()),
                    *map(pa.array, register_bits(rows)),
                ],
                ["doc_id", "n_shingles", "set_a", "set_b", "registers", "bits_a", "bits_b"],
            )


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches):
        rows = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16)
        rows = rows.reshape(-1, BUCKETS).astype(np.uint64)
        key = np.broadcast_to(mix64(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(rows), BANDS))
        with np.errstate(over="ignore"):
            for j in range(BAND):
                key = mix64(key + rows[:, _SUBSETS[:, j]])
        doc, column = np.nonzero(np.broadcast_to(rows.any(1)[:, None], key.shape))
        ids = batch.column(0).take(pa.array(doc))
        yield pa.RecordBatch.from_arrays(
            [pa.array(key[doc, column].view(np.int64)), ids], ["band", "id"]
        )


def _estimate(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Keep the pairs whose similarity may reach the threshold.

    The margin is six standard deviations of the share of equal registers, so that a
    pair above the threshold is practically never dropped.
    """
    for batch in small_batches(batches):
        a, b = (
            np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, BUCKETS)
            for i in (2, 3)
        )
        share, n = jaccard_estimate(a, b)
        margin = SIGMAS * np.sqrt(threshold * (1 - threshold) / np.maximum(n, 1))
        keep = pa.array(share >= threshold - margin)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"]
        )


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, data, offsets in text_slices(batch.column(1), SMALL_SLICE_BYTES):
            hashes, first = shingle_sets(data, offsets, n)
            sets = [hashes[i:j].tobytes() for i, j in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(low, high - low), pa.array(sets, pa.binary())],
                ["id", "members"],
            )


def _members(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), np.uint64) for v in column]


def _overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes of two sets and of their intersection."""
    for batch in small_batches(batches):
        left, right = _members(batch.column(2)), _members(batch.column(3))
        both = [
            len(np.intersect1d(x, y, assume_unique=True))
            for x, y in zip(left, right, strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:2],
                *(pa.array([len(x) for x in side], pa.int64()) for side in (left, right)),
                pa.array(both, pa.int64()),
            ],
            ["a", "b", "n_a", "n_b", "both"],
        )


def _differences(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Elements by which a text (b) differs from its hub (a), one row each."""
    for batch in small_batches(batches):
        sides = (
            (len(y), np.setdiff1d(y, h, assume_unique=True), np.setdiff1d(h, y, assume_unique=True))
            for h, y in zip(*map(_members, batch.columns[2:4]), strict=True)
        )
        yield difference_rows(batch.column(0), batch.column(1), sides, percent)


def _with_both(pairs: DataFrame, side: DataFrame, value: str) -> DataFrame:
    """``pairs`` with the values of both ends; all are written tables."""
    left = side.select(F.col("id").alias("a"), F.col(value).alias("_va"))
    right = side.select(F.col("id").alias("b"), F.col(value).alias("_vb"))
    rest = [c for c in pairs.columns if c not in ("a", "b")]
    return pairs.join(left, "a").join(right, "b").select("a", "b", "_va", "_vb", *rest)


class _Comparer:
    """Compares pairs of documents: estimate first, full sets then."""

    def __init__(self, docs: DataFrame, marks: DataFrame, shingle: int, percent: int) -> None:
        self.docs, self.marks = docs, marks
        self.shingle, self.percent = shingle, percent
        self.kind = docs.schema["doc_id"].dataType.simpleString()

    def estimated(self, pairs: DataFrame, percent: int) -> DataFrame:
        """The pairs whose similarity may be ``percent`` or more."""
        found = _with_both(pairs, self.marks, "registers").mapInArrow(
            partial(_estimate, threshold=percent / 100), f"a {self.kind}, b {self.kind}"
        )
        return materialize(found, "near-pairs")

    def sets(self, pairs: DataFrame) -> DataFrame:
        """``(id, members)`` of the documents in ``pairs``."""
        needed = pairs.select(F.col("a").alias("_id")).union(pairs.select("b")).distinct()
        found = self.docs.join(
            materialize(needed, "needed-ids"), F.col("doc_id") == F.col("_id"), "left_semi"
        ).mapInArrow(
            partial(_sets, n=self.shingle), f"id {self.kind}, members binary"
        )
        return materialize(found, "shingle-sets")

    def compared(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """``(a, b, n_a, n_b, both)``: the exact sizes."""
        sizes = _with_both(pairs, sets, "members").mapInArrow(
            _overlap,
            f"a {self.kind}, b {self.kind}, n_a bigint, n_b bigint, both bigint",
        )
        return materialize(sizes, "compared-pairs")

    def links(self, pairs: DataFrame) -> DataFrame:
        near = self.estimated(pairs, self.percent)
        return self.compared(near, self.sets(near)).filter(reaches(self.percent)).select("a", "b")


def reaches(percent: int) -> Column:
    """The intersection is at least ``percent`` of the union."""
    union = F.col("n_a") + F.col("n_b") - F.col("both")
    return 100 * F.col("both") >= percent * union


def _within_reach_of_hub(
    compare: _Comparer, seen: DataFrame, sets: DataFrame, found: DataFrame
) -> DataFrame:
    """Pairs near the same hub that may be linked, of different components so far."""
    percent = compare.percent
    of_a = found.select(F.col("node").alias("a"), F.col("component").alias("_ca"))
    of_b = found.select(F.col("node").alias("b"), F.col("component").alias("_cb"))
    near = seen.filter(reaches(2 * percent - 100)).join(of_a, "a", "left").join(of_b, "b", "left")
    component = F.coalesce("_cb", "b")
    near = near.select(
        "a",
        "b",
        "n_a",
        "n_b",
        "both",
        component.alias("component"),
        (component != F.coalesce("_ca", "a")).alias("loose"),
    )
    near = materialize(near, "hub-near")
    open_hubs = near.groupBy(F.col("a").alias("_hub")).agg(
        F.count_if("loose").alias("_loose"), F.count("*").alias("_all")
    )
    open_hubs = open_hubs.filter((F.col("_loose") > 0) & (F.col("_all") > 1)).select("_hub")
    near = near.join(materialize(open_hubs, "open-hubs"), F.col("a") == F.col("_hub"), "left_semi")
    near = materialize(near.drop("loose"), "open-members")
    kind = compare.kind
    parts = _with_both(near.select("a", "b"), sets, "members").mapInArrow(
        partial(_differences, percent=percent),
        f"hub {kind}, id {kind}, element bigint, gone boolean",
    )
    members = near.withColumnsRenamed({"a": "hub", "b": "id"})
    return pairs_by_differences(members, materialize(parts, "hub-differences"), percent)


def _of_different_parts(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs that are not in the same component yet, as a written table."""
    of_a = found.select(F.col("node").alias("a"), F.col("component").alias("_ca"))
    of_b = found.select(F.col("node").alias("b"), F.col("component").alias("_cb"))
    pairs = pairs.join(of_a, "a", "left").join(of_b, "b", "left")
    apart = ~F.coalesce(F.col("_ca") == F.col("_cb"), F.lit(False))
    return materialize(pairs.filter(apart).select("a", "b"), "open-pairs")


def _with_hubs(banded: DataFrame) -> DataFrame:
    """``(band, id, hub, n)`` of the bands of two or more.

    The hub is the member whose bands are the most crowded altogether: of a group of
    copies, one near its middle.
    """
    counts = banded.groupBy("band").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    shared = materialize(banded.join(materialize(counts, "band-counts"), "band"), "shared-bands")
    crowd = materialize(shared.groupBy("id").agg(F.sum("n").alias("crowd")), "crowds")
    hubs = (
        shared.join(crowd, "id")
        .groupBy("band")
        .agg(F.max_by("id", F.struct("crowd", "id")).alias("hub"))
    )
    members = shared.join(materialize(hubs, "band-hubs"), "band")
    return materialize(members.select("band", "id", "hub", "n"), "band-members")


def _out_of_reach_of_hub(
    members: DataFrame, marks: DataFrame, seen: DataFrame, found: DataFrame, percent: int
) -> DataFrame:
    """Pairs of a band that are not linked to its hub, one of them far from it.

    Only pairs whose register bits are alike enough leave the join.
    """
    state = F.when(reaches(percent), 2).when(reaches(2 * percent - 100), 1)
    state = materialize(
        seen.select(F.col("a").alias("hub"), F.col("b").alias("id"), state.alias("state")),
        "hub-states",
    )
    others = members.filter((F.col("n") > 2) & (F.col("id") != F.col("hub")))
    placed = others.join(state, ["hub", "id"], "left").select(
        "band", "id", F.coalesce("state", F.lit(0)).alias("state")
    )
    placed = materialize(placed.filter(F.col("state") < 2), "free-members")
    free = placed.join(marks.select("id", "bits_a", "bits_b"), "id")
    free = materialize(free, "free-bits")
    far = materialize(free.filter(F.col("state") == 0), "far-bits")
    pairs = (
        free.alias("y")
        .join(
            far.alias("x"),
            (F.col("x.band") == F.col("y.band"))
            & (F.col("x.id") != F.col("y.id"))
            & may_reach(percent),
        )
        .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))
        .distinct()
    )
    return _of_different_parts(materialize(pairs, "far-pairs"), found)


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every row.

    Texts are compared as sets of ``shingle``-word runs, in lower case for A-Z; a
    shorter text is one run. Two texts are linked if their sets' intersection is at
    least ``percent`` of their union. ``component_id`` is the smallest id that links
    reach, ``kept`` whether that is the row's own. A null, empty or blank text has no
    set and no link. Equal texts share a component; rows that repeat an id get equal
    results. A row with a null id links nothing and stays. No rows give no rows. Columns
    other than the two named are not looked at.

    ``percent`` is 50 to 100: below, what a hub rules out would not follow from the
    triangle inequality.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be between 50 and 100")
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    signed = materialize(
        docs.mapInArrow(
            partial(_signatures, n=shingle),
            f"doc_id {kind}, n_shingles bigint, set_a bigint, set_b bigint, registers binary, "
            "bits_a bigint, bits_b bigint",
        ),
        "signatures",
    )
    known = signed.filter(F.col("n_shingles") > 0).filter(F.col("doc_id").isNotNull())
    classes = materialize(
        known.groupBy("set_a", "set_b", "n_shingles").agg(
            F.min("doc_id").alias("id"),
            F.count("*").alias("rows"),
            *(F.any_value(c).alias(c) for c in ("registers", "bits_a", "bits_b")),
        ),
        "classes",
    )
    marks = classes.select("id", "registers", "bits_a", "bits_b")
    banded = marks.select("id", "registers").mapInArrow(_bands, f"band bigint, id {kind}")
    banded = materialize(banded, "bands")
    members = _with_hubs(banded)
    tested = materialize(
        members.filter(F.col("id") != F.col("hub"))
        .select(F.col("hub").alias("a"), F.col("id").alias("b"))
        .distinct(),
        "hub-pairs",
    )
    compare = _Comparer(docs, marks, shingle, percent)
    near = compare.estimated(tested, 2 * percent - 100)
    sets = compare.sets(near)
    seen = compare.compared(near, sets)
    links = seen.filter(reaches(percent)).select("a", "b")
    found = materialize(components(links), "components")
    rest = _within_reach_of_hub(compare, seen, sets, found).union(
        _out_of_reach_of_hub(members, marks, seen, found, percent)
    )
    if not rest.isEmpty():
        links = links.union(compare.links(materialize(rest.distinct(), "rest")))
        found = materialize(components(links), "components")
    of_class = materialize(
        classes.join(found, F.col("id") == F.col("node"), "left")
        .filter((F.col("rows") > 1) | F.col("component").isNotNull())
        .select(
            F.col("set_a").alias("_a"),
            F.col("set_b").alias("_b"),
            F.col("n_shingles").alias("_n"),
            F.coalesce("component", "id").alias("component_id"),
        ),
        "class-components",
    )
    same = (
        (F.col("set_a") == F.col("_a"))
        & (F.col("set_b") == F.col("_b"))
        & (F.col("n_shingles") == F.col("_n"))
    )
    return signed.join(of_class, same, "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias(
            "component_id"
        ),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias(
            "kept"
        ),
    )


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each group of near copies, all columns kept.

    The row with the smallest id stays; of rows that repeat an id with the same set,
    any one. Rows with a null id or without words all stay. Whatever else the columns of
    ``docs`` are called, they come out as they were.
    """
    gone_id, twice_id = fresh(docs, "_gone", "_twice")
    id_col = options.get("id_col", "doc_id")
    result = settle(partial(near_duplicates, docs, **options), "near-duplicates")
    gone = materialize(
        result.filter(~F.col("kept")).select(F.col("doc_id").alias(gone_id)).distinct(),
        "near-copies",
    )
    rest = docs.join(gone, F.col(id_col) == F.col(gone_id), "left_anti")
    repeated = (
        result.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
        .groupBy("doc_id")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > 1)
    )
    if repeated.isEmpty():
        return rest
    twice = materialize(repeated.select(F.col("doc_id").alias(twice_id)), "repeated-ids")
    once = rest.join(twice, F.col(id_col) == F.col(twice_id), "left_anti")
    return once.unionByName(
        rest.join(twice, F.col(id_col) == F.col(twice_id), "left_semi").dropDuplicates([id_col])
    )
