"""Exact Jaccard join of shingle sets by universe partition and the pigeonhole principle.

Two sets linked at 80 % differ in at most H elements, H from their sizes. Tokens are dealt
into m segments by hash. Give segment i of a set the share v of the budget: 0 (not used),
1 (its subset must be equal) or 2 (equal but for one element, found through the subset
and its one-deletion neighbourhood). If the shares sum to H + 1, some segment agrees within
its share. Sizes form bands as wide as a link can be, so a set takes part in the scheme
of its own band, as smaller or equal partner, and in that of the band below.

Shares are given by cost, the number of keys and how common they may be:

* The larger set of a pair probes: it spends its shares on the fullest segments, whose
  subsets are the rarest, and none on the others. The smaller one has all indexed.
  A group of equal keys that no set probes is dropped.
* A scheme whose subsets hold few elements on average takes half the segments, with a
  share of 2 each. Keys are many there, but sets are small and the subsets selective.
* Other schemes use shares of 1, and filled segments only. m is large enough that a set
  lacks filled segments with a probability below 1e-9; a set that does lack them is
  found through H + 1 single elements instead.

Keys of a slice travel as packed arrays, dealt by hash; a task keeps each of its keys once
and passes on those of two sets or more. Members of such a group are compared with one of
them, its hub, on full sets. Two members that the hub does not settle differ from it,
and if they are linked, they share most of these differences: a prefix join on the
rarest differences finds them, where groups of any size cost in proportion to their
members. No link between different sets is lost, and none is assumed: all are verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from math import ceil, comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflow.llm.components import components
from odflow.llm.hub_pairs import difference_rows, pairs_by_differences
from odflow.llm.near_dedup import shingle_sets
from odflow.llm.text import SMALL_SLICE_BYTES, mix64, small_batches, text_slices
from odflow.sources.scratch import materialize

# A probability of too few filled segments above this makes a scheme larger.
LACKING = 1e-9
# Schemes with fewer elements than this in a segment give shares of 2.
FILLED = 2.5
KEYS_PER_TASK = 1_000_000
MERGE_KEYS = 400_000
DEAL_KEYS = 200_000
FILTER_BITS = 26


def differ_at_most(percent: int, total: int) -> int:
    """Elements by which two linked sets of ``total`` elements together may differ."""
    return (100 - percent) * total // (100 + percent)


@lru_cache(maxsize=None)
def _band(number: int, percent: int) -> tuple[int, int]:
    if number == 0:
        return 1, 100 // percent
    low = _band(number - 1, percent)[1] + 1
    return low, low * 100 // percent


@lru_cache(maxsize=None)
def _highest(percent: int, size: int) -> tuple[int, ...]:
    """Upper ends of the bands up to the one of ``size``."""
    ends, number = [], 0
    while not ends or ends[-1] < size:
        ends.append(_band(number, percent)[1])
        number += 1
    return tuple(ends)


def band_of(sizes: np.ndarray, percent: int) -> np.ndarray:
    return np.searchsorted(np.array(_highest(percent, int(sizes.max(initial=1)))), sizes)


def _needed(size: int, high: int, percent: int) -> int:
    """Shares that a set needs against partners of at most its size in a band."""
    return differ_at_most(percent, size + min(size, high)) + 1


def _lacking(segments: int, size: int, needed: int) -> float:
    """Bound of the probability that fewer than ``needed`` segments are filled."""
    bare = segments - needed + 1
    if bare >= segments:
        return 0.0 if needed <= 1 else 1.0
    return log(comb(segments, bare)) + size * log(1 - bare / segments)


@lru_cache(maxsize=None)
def scheme(number: int, percent: int) -> tuple[int, bool]:
    """Segments of a band's scheme, and whether their share is 2.

    No segments, if sets of these sizes are linked only if they are equal.
    """
    low, high = _band(number, percent)
    top = high * 100 // percent
    most = _needed(top, high, percent)
    if most == 1:
        return 0, False
    sizes = sorted({low, high, top, *np.linspace(low, top, 24).astype(int).tolist()})
    bound = log(LACKING)

    def enough(segments: int) -> bool:
        return all(
            _lacking(segments, s, _needed(s, high, percent)) <= bound
            for s in sizes
            if _needed(s, high, percent) > 1
        )

    segments, most_useful = most, int(low / FILLED)
    while segments <= most_useful and not enough(segments):
        segments += max(1, segments // 32)
    if segments <= most_useful:
        return segments, False
    return ceil(most / 2), True


def _keys(
    contents: np.ndarray, number: np.ndarray, segment: np.ndarray, probe: np.ndarray
) -> np.ndarray:
    """Keys whose last bit tells whether the set probes with them."""
    with np.errstate(over="ignore"):
        number = number.astype(np.uint64) + np.uint64(1)
        place = mix64(number << np.uint64(32) | segment.astype(np.uint64))
        return mix64(contents + place) & ~np.uint64(1) | probe.astype(np.uint64)


def _fullest(counts: np.ndarray, doc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Marks the ``n[doc]`` fullest segments of every set; ``doc`` is in rising order."""
    order = np.lexsort((-counts, doc))
    per = np.bincount(doc, minlength=len(n))
    rank = np.arange(len(order)) - np.repeat(np.cumsum(per) - per, per)
    marks = np.zeros(len(doc), bool)
    marks[order] = rank < n[doc[order]]
    return marks


def _segment(hashes: np.ndarray, segments: np.ndarray) -> np.ndarray:
    """Segment of each element: an equal part of the hashes, in their order."""
    return ((hashes >> np.uint64(32)) * segments.astype(np.uint64) >> np.uint64(32)).astype(np.int64)


def signatures(
    hashes: np.ndarray, first: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, the set of each, and the sets that lack filled segments.

    ``hashes`` are the elements of all sets, in rising order in each.
    """
    sizes = np.diff(first)
    bands = band_of(sizes, percent)
    mixed = mix64(hashes)
    with np.errstate(over="ignore"):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mixed)])
    keys, owners, lacking = [], [], []
    for step in (0, 1):
        plan = {}
        for number in np.unique(bands[sizes > 0] - step).tolist():
            if number >= 0:
                segments, double = scheme(number, percent)
                high = _band(number, percent)[1]
                plan[number] = segments, double, high
        if not plan:
            continue
        table = np.zeros((max(plan) + 1, 3), np.int64)
        for number, row in plan.items():
            table[number] = row
        number = bands - step
        # A set above every partner's reach has no part in the band below.
        joins = (sizes > 0) & (number >= 0)
        joins &= sizes * percent <= 100 * table[np.maximum(number, 0), 2]
        joins &= table[np.maximum(number, 0), 0] > 0
        for double in (False, True):
            chosen = np.flatnonzero(joins & (table[np.maximum(number, 0), 1] == double))
            if not len(chosen):
                continue
            segments, high = table[number[chosen], 0], table[number[chosen], 2]
            doc = np.repeat(np.arange(len(chosen)), sizes[chosen])
            base = np.concatenate([[0], np.cumsum(segments)])
            at = np.arange(len(doc)) + np.repeat(
                first[chosen] - np.concatenate([[0], np.cumsum(sizes[chosen])[:-1]]), sizes[chosen]
            )
            slot = base[doc] + _segment(hashes[at], segments[doc])
            pick = _deletions if double else _filled
            found = pick(
                slot, at, base, mixed, total, chosen, segments, number[chosen],
                differ_at_most_all(sizes[chosen], high, percent) + 1, step,
            )
            keys.append(found[0])
            owners.append(found[1])
            lacking.append(found[2])
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(map(np.concatenate, (keys, owners, lacking)))


def differ_at_most_all(sizes: np.ndarray, high: np.ndarray, percent: int) -> np.ndarray:
    return (100 - percent) * (sizes + np.minimum(sizes, high)) // (100 + percent)


def _filled(slot, at, base, mixed, total, chosen, segments, number, needed, step):
    """Subsets of the filled segments: all in a set's own band, else those it probes."""
    new = np.ones(len(slot), bool)
    new[1:] = slot[1:] != slot[:-1]
    starts = np.flatnonzero(new)
    counts = np.diff(np.concatenate([starts, [len(slot)]]))
    doc = np.searchsorted(base, slot[starts], "right") - 1
    with np.errstate(over="ignore"):
        contents = total[at[starts] + counts] - total[at[starts]]
    probe = _fullest(counts, doc, needed)
    keys = _keys(contents, number[doc], slot[starts] - base[doc], probe)
    lacking = chosen[np.bincount(doc, minlength=len(chosen)) < needed]
    if step:
        keys, doc = keys[probe], doc[probe]
    return keys, chosen[doc], lacking


def _deletions(slot, at, base, mixed, total, chosen, segments, number, needed, step):
    """Subsets of the segments, and each with one element left out."""
    places = np.arange(base[-1])
    low = np.searchsorted(slot, places)
    high = np.searchsorted(slot, places, "right")
    # Elements of the chosen sets lie side by side only within a set.
    inside = np.concatenate([[np.uint64(0)], np.cumsum(mixed[at], dtype=np.uint64)])
    doc = np.repeat(np.arange(len(chosen)), segments)
    with np.errstate(over="ignore"):
        contents = inside[high] - inside[low]
        without = contents[slot] - mixed[at]
    probe = _fullest(high - low, doc, (needed + 1) // 2)
    both = np.concatenate([contents, without])
    place = np.concatenate([places, slot])
    docs = doc[place]
    keys = _keys(both, number[docs], place - base[docs], probe[place])
    if step:
        keys, docs = keys[probe[place]], docs[probe[place]]
    return keys, chosen[docs], np.zeros(0, np.int64)


def set_ids(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One 64-bit id per set; equal sets have the same."""
    with np.errstate(over="ignore"):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix64(hashes ^ np.uint64(1)))])
        own = total[first[1:]] - total[first[:-1]]
        return mix64(own + np.diff(first).astype(np.uint64)).view(np.int64)


def _sizes(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, data, offsets in text_slices(batch.column(1), SMALL_SLICE_BYTES):
            hashes, first = shingle_sets(data, offsets, shingle)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(low, high - low),
                    pa.array(np.diff(first)),
                    pa.array(set_ids(hashes, first)),
                ],
                ["doc_id", "n_shingles", "set_id"],
            )


def _dealt(
    batches: Iterator[pa.RecordBatch], shingle: int, percent: int, parts: int
) -> Iterator[pa.RecordBatch]:
    """Keys and their sets in packed arrays, one row per part and ``DEAL_KEYS`` keys.

    Rows of part -1 hold the sets that lack filled segments.
    """
    waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def packed() -> pa.RecordBatch:
        keys, owners, lacking = map(np.concatenate, zip(*waiting, strict=True))
        waiting.clear()
        part = (keys >> np.uint64(20)) % np.uint64(parts)
        order = np.argsort(part, kind="stable")
        keys, owners, part = keys[order], owners[order], part[order]
        cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else []
        ends = [*cuts[1:], len(part)] if len(part) else []
        rows = [
            (int(part[i]), keys[i:j].tobytes(), owners[i:j].tobytes())
            for i, j in zip(cuts, ends, strict=True)
        ]
        if len(lacking):
            rows.append((-1, b"", np.unique(lacking).tobytes()))
        columns = zip(*rows, strict=True) if rows else ((), (), ())
        types = pa.int32(), pa.binary(), pa.binary()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["part", "keys", "ids"]
        )

    for batch in batches:
        for _, _, data, offsets in text_slices(batch.column(0), SMALL_SLICE_BYTES):
            hashes, first = shingle_sets(data, offsets, shingle)
            ids = set_ids(hashes, first)
            keys, owners, lacking = signatures(hashes, first, percent)
            waiting.append((keys, ids[owners], ids[lacking]))
            if sum(len(k) for k, _, _ in waiting) >= DEAL_KEYS:
                yield packed()
    if waiting:
        yield packed()


def _pair_rows(keys: np.ndarray, ids: np.ndarray, probes: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(keys.view(np.int64)), pa.array(ids), pa.array(probes)], ["key", "id", "probe"]
    )


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(key, id, probe)`` of the keys that two sets or more have.

    The task remembers one set per key. A key on very many sets therefore takes no more
    room than any other: its later sets go straight on. Sets that lack filled segments
    pass as rows of key 0.
    """
    known = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, bool)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def merged():
        nonlocal known
        n = len(known[0])
        marked = [k for k, _ in waiting]
        keys = np.concatenate([known[0], *(k & ~np.uint64(1) for k in marked)])
        ids = np.concatenate([known[1], *(i for _, i in waiting)])
        probes = np.concatenate([known[2], *((k & np.uint64(1)).astype(bool) for k in marked)])
        waiting.clear()
        del marked
        passed = np.concatenate([known[3], np.zeros(len(keys) - n, bool)])
        order = np.argsort(keys, kind="stable").astype(np.int32)
        keys, ids, probes, passed = keys[order], ids[order], probes[order], passed[order]
        del order
        lead = np.ones(len(keys), bool)
        lead[1:] = keys[1:] != keys[:-1]
        group = np.cumsum(lead, dtype=np.int32) - 1
        other = ids != ids[lead][group]
        shared = np.zeros(np.count_nonzero(lead), bool)
        shared[group[other]] = True
        out = other | (lead & shared[group] & ~passed)
        known = keys[lead], ids[lead], probes[lead], passed[lead] | shared
        return _pair_rows(keys[out], ids[out], probes[out])

    size = 0
    for batch in batches:
        for part, key, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            ids = np.frombuffer(own, np.int64)
            if part < 0:
                yield _pair_rows(np.zeros(len(ids), np.uint64), ids, np.zeros(len(ids), bool))
                continue
            waiting.append((np.frombuffer(key, np.uint64), ids))
            size += len(ids)
            if size >= MERGE_KEYS:
                size = 0
                yield merged()
    yield merged()


def _marks(wanted: DataFrame) -> np.ndarray:
    """A Bloom filter of the ids: at most 8 MB, however many ids there are.

    It only keeps most of the other sets from travelling; the join behind it is exact.
    """
    n = wanted.count()
    bits = min(max(10, (16 * n).bit_length()), FILTER_BITS)
    spots = [F.col("id"), F.shiftrightunsigned("id", 32)]
    spot = F.explode(F.array(*(s.bitwiseAND(F.lit((1 << bits) - 1)) for s in spots)))
    words = (
        wanted.select(spot.alias("spot"))
        .groupBy(F.shiftright("spot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(spot & 63 AS INT))")).alias("bits"))
        .toArrow()
    )
    table = np.zeros(1 << (bits - 6), np.int64)
    table[words.column(0).to_numpy()] = words.column(1).to_numpy()
    return table


def _marked(ids: np.ndarray, table: np.ndarray) -> np.ndarray:
    found = np.ones(len(ids), bool)
    for spots in (ids.view(np.uint64), ids.view(np.uint64) >> np.uint64(32)):
        spots = (spots & np.uint64(64 * len(table) - 1)).astype(np.int64)
        found &= table[spots >> 6].view(np.uint64) >> (spots & 63).astype(np.uint64) & np.uint64(1) == 1
    return found


def _full_sets(
    batches: Iterator[pa.RecordBatch], shingle: int, marks: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """The elements of the texts whose set is marked."""
    for batch in batches:
        for _, _, data, offsets in text_slices(batch.column(0), SMALL_SLICE_BYTES):
            hashes, first = shingle_sets(data, offsets, shingle)
            ids = set_ids(hashes, first)
            rows = np.flatnonzero(_marked(ids, marks) & (np.diff(first) > 0))
            sets = [hashes[first[i] : first[i + 1]].tobytes() for i in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[rows]), pa.array(sets, pa.binary())], ["id", "members"]
            )


def _elements(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), np.uint64) for v in column]


def _overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes of both sets and of what they share.

    Of a group of three sets or more (n), also the elements by which b differs from a.
    """
    for batch in small_batches(batches):
        rows = []
        for h, x, n in zip(
            _elements(batch.column("_sa")),
            _elements(batch.column("_sb")),
            batch.column("n").to_pylist(),
            strict=True,
        ):
            if n > 2:
                added = np.setdiff1d(x, h, assume_unique=True)
                gone = np.setdiff1d(h, x, assume_unique=True)
                both = len(x) - len(added)
                rows.append((len(h), len(x), both, added.tobytes(), gone.tobytes()))
            else:
                both = len(np.intersect1d(x, h, assume_unique=True))
                rows.append((len(h), len(x), both, None, None))
        columns = zip(*rows, strict=True) if rows else [()] * 5
        types = [pa.int64()] * 3 + [pa.binary()] * 2
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("a", "b", "n")),
                *(pa.array(c, t) for c, t in zip(columns, types, strict=True)),
            ],
            ["a", "b", "n", "n_a", "n_b", "both", "added", "gone"],
        )


def _differences(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Elements by which sets differ from their hub, one row each."""
    for batch in small_batches(batches):
        sides = zip(
            batch.column("n_b").to_pylist(),
            _elements(batch.column("added")),
            _elements(batch.column("gone")),
            strict=True,
        )
        yield difference_rows(batch.column("a"), batch.column("b"), sides, percent)


def _compared(pairs: DataFrame, sets: DataFrame, label: str) -> DataFrame:
    """``(a, b, n, n_a, n_b, both, added, gone)``, written.

    The sets of b travel to a, once per pair. Those of a are hubs: few, and often large.
    """
    hubs = materialize(pairs.select(F.col("a").alias("id")).distinct(), f"{label}-hubs")
    left = sets.join(hubs, "id", "left_semi").select(
        F.col("id").alias("a"), F.col("members").alias("_sa")
    )
    right = sets.select(F.col("id").alias("b"), F.col("members").alias("_sb"))
    both = pairs.join(right, "b").join(materialize(left, f"{label}-sets"), "a")
    sizes = both.select("a", "b", "n", "_sa", "_sb").mapInArrow(
        _overlap,
        "a bigint, b bigint, n bigint, n_a bigint, n_b bigint, both bigint, added binary, gone binary",
    )
    return materialize(sizes, label)


def linked(percent: int) -> Column:
    union = F.col("n_a") + F.col("n_b") - F.col("both")
    return 100 * F.col("both") >= percent * union


def _groups(shared: DataFrame) -> DataFrame:
    """``(hub, id, n)``: each set with the hubs of its keys, and the largest such group.

    The hub is the member whose keys are the most crowded: in a group of copies the one
    with the fewest edits.
    """
    counts = shared.groupBy("key").agg(F.count("*").alias("n"), F.max("probe").alias("probed"))
    counts = materialize(counts.filter("probed").select("key", "n"), "key-counts")
    used = materialize(shared.join(counts, "key").select("key", "id", "n"), "probed-keys")
    crowd = materialize(used.groupBy("id").agg(F.sum("n").alias("crowd")), "crowds")
    hubs = (
        used.join(crowd, "id")
        .groupBy("key")
        .agg(F.max_by("id", F.struct("crowd", "id")).alias("hub"))
    )
    members = used.join(materialize(hubs, "key-hubs"), "key").filter(F.col("id") != F.col("hub"))
    return members.groupBy("hub", "id").agg(F.max("n").alias("n"))


def _placed(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """``pairs`` with the components ``_ca``, ``_cb`` of both ends."""
    of_a = found.select(F.col("node").alias("a"), F.col("component").alias("_ca"))
    of_b = found.select(F.col("node").alias("b"), F.col("component").alias("_cb"))
    both = pairs.join(of_a, "a", "left").join(of_b, "b", "left")
    return both.withColumns({"_ca": F.coalesce("_ca", "a"), "_cb": F.coalesce("_cb", "b")})


def _unsettled(seen: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of a hub that may be linked, but not through what is found."""
    placed = _placed(seen.filter(F.col("n") > 2), found)
    hubs = placed.groupBy(F.col("a").alias("_hub")).agg(
        F.count_if(F.col("_ca") != F.col("_cb")).alias("_loose"), F.count("*").alias("_all")
    )
    hubs = hubs.filter((F.col("_loose") > 0) & (F.col("_all") > 1)).select("_hub")
    hubs = materialize(hubs, "open-hubs")
    placed = placed.join(hubs, F.col("a") == F.col("_hub"), "left_semi").select(
        "a", "b", "n_a", "n_b", "both", "added", "gone", F.col("_cb").alias("component")
    )
    placed = materialize(placed, "hub-members")
    parts = placed.select("a", "b", "n_b", "added", "gone").mapInArrow(
        partial(_differences, percent=percent),
        "hub bigint, id bigint, element bigint, gone boolean",
    )
    members = placed.withColumnsRenamed({"a": "hub", "b": "id"})
    return pairs_by_differences(members, materialize(parts, "hub-differences"), percent)


def _through_elements(
    docs: DataFrame, lacking: DataFrame, sets: DataFrame, shingle: int, percent: int
) -> DataFrame:
    """Pairs of the sets that lack filled segments with all sets that hold one of a few
    of their elements: H + 1 of them, of which a linked set has at least one."""
    few = sets.join(lacking, "id", "left_semi").mapInArrow(
        partial(_some_elements, percent=percent), "id bigint, element bigint"
    )
    few = materialize(few, "single-elements")
    every = docs.select("text").mapInArrow(
        partial(_all_elements, shingle=shingle), "b bigint, element bigint"
    )
    pairs = every.join(few, "element").filter(F.col("id") != F.col("b"))
    return pairs.select(F.col("id").alias("a"), "b").distinct()


def _some_elements(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, own in enumerate(_elements(batch.column("members"))):
            n = differ_at_most(percent, 2 * len(own)) + 1
            few = own[:n].view(np.int64)
            ids = batch.column("id").take(pa.array(np.full(len(few), i)))
            yield pa.RecordBatch.from_arrays([ids, pa.array(few)], ["id", "element"])


def _all_elements(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, data, offsets in text_slices(batch.column(0), SMALL_SLICE_BYTES):
            hashes, first = shingle_sets(data, offsets, shingle)
            ids = np.repeat(set_ids(hashes, first), np.diff(first))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(hashes.view(np.int64))], ["b", "element"]
            )


def jaccard_components(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row.

    A text is the set of its ``shingle``-word runs, in lower case for A-Z; a shorter text
    is one run. Texts are linked if ``percent`` (51 to 100) of the union of their sets or
    more is in both. ``component_id`` is the smallest id that links reach. Null, empty and
    blank texts have no set and no link: their component is their own id. Rows that
    repeat an id are texts of their own. A row with a null id links nothing and has no
    component. No rows give no rows. Other columns are ignored, whatever their names.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be 51 to 100")
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    sized = materialize(
        docs.mapInArrow(
            partial(_sizes, shingle=shingle),
            f"doc_id {kind}, n_shingles bigint, set_id bigint",
        ),
        "set-sizes",
    )
    known = sized.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = known.groupBy(F.col("set_id").alias("id")).agg(
        F.min("doc_id").alias("least_doc"), F.sum("n_shingles").alias("elements")
    )
    classes = materialize(classes, "set-classes")
    elements = classes.agg(F.sum("elements")).first()[0] or 0
    parts = max(64, ceil(elements / KEYS_PER_TASK) * 8)
    keyed = docs.filter(F.col("doc_id").isNotNull()).select("text")
    dealt = keyed.mapInArrow(
        partial(_dealt, shingle=shingle, percent=percent, parts=parts),
        "part int, keys binary, ids binary",
    )
    dealt = dealt.repartition(max(1, parts // 8), "part")
    shared = dealt.mapInArrow(_shared, "key bigint, id bigint, probe boolean")
    shared = materialize(shared.distinct(), "shared-keys")
    lacking = shared.filter(F.col("key") == 0).select("id")
    groups = materialize(_groups(shared.filter(F.col("key") != 0)), "hub-groups")
    pairs = groups.select(F.col("hub").alias("a"), F.col("id").alias("b"))
    needed = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).union(lacking).distinct()
    needed = materialize(classes.join(needed, "id", "left_semi"), "needed-sets")

    def full_sets(wanted: DataFrame) -> DataFrame:
        sets = keyed.mapInArrow(
            partial(_full_sets, shingle=shingle, marks=_marks(wanted)), "id bigint, members binary"
        )
        sets = sets.join(wanted.select("id"), "id", "left_semi").groupBy("id")
        return materialize(sets.agg(F.any_value("members").alias("members")), "full-sets")

    sets = full_sets(needed)
    pairs = groups.select(F.col("hub").alias("a"), F.col("id").alias("b"), "n")
    seen = _compared(pairs, sets, "hub-pairs")
    links = seen.filter(linked(percent)).select("a", "b")
    found = materialize(components(links), "set-components")
    rest = _unsettled(seen, found, percent)
    if not lacking.isEmpty():
        more = materialize(_through_elements(docs, lacking, sets, shingle, percent), "element-pairs")
        partners = classes.join(more.select(F.col("b").alias("id")), "id", "left_semi")
        sets = full_sets(materialize(needed.union(partners).distinct(), "needed-sets"))
        rest = rest.union(more)
    rest = materialize(rest.distinct(), "open-pairs")
    if not rest.isEmpty():
        late = _compared(rest.withColumn("n", F.lit(2).cast("bigint")), sets, "late-pairs")
        late = late.filter(linked(percent)).select("a", "b")
        links = materialize(links.union(late), "all-links")
        found = materialize(components(links), "set-components")
    of_set = classes.join(found, F.col("id") == F.col("node"), "left").withColumn(
        "component", F.coalesce("component", "id")
    )
    least = of_set.groupBy("component").agg(F.min("least_doc").alias("component_id"))
    of_set = of_set.join(materialize(least, "least-documents"), "component")
    of_set = materialize(of_set.select(F.col("id").alias("_set"), "component_id"), "set-documents")
    has_set = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("set_id"))
    return sized.join(of_set, has_set == F.col("_set"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
