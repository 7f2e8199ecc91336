"""Pairs of sets near the same hub that may be linked, found on their rarest differences.

Two sets differ from a hub by the elements that they add and those that are gone. With d
the numbers of these, linked sets share at least (d1 + d2 - H) / 2 of them. A set that is
not linked to the hub makes this above 0, so sets of different components, one of which is
not the hub's, have a difference in common. Ordered by how many members share them, the
rarest first, a shared one is in a prefix of either side; the prefix of the side with
fewer differences is the shorter one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflow.sources.scratch import materialize


def longest_prefix(percent: int, size: int) -> int:
    """Differences of a set that any step below looks at, at most."""
    return (100 - percent) * size // percent + 2


def difference_rows(
    hubs: pa.Array, ids: pa.Array, sides: Iterator[tuple[int, np.ndarray, np.ndarray]], percent: int
) -> pa.RecordBatch:
    """``(hub, id, element, gone)`` from sizes of sets, their added and gone elements.

    What the hub has and the set has not comes last in every order, so it is left
    out where the other elements fill the longest prefix that is used.
    """
    rows, elements, marks = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, bool)]
    for i, (size, added, gone) in enumerate(sides):
        if len(added) > longest_prefix(percent, size):
            gone = gone[:0]
        n = len(added) + len(gone)
        rows.append(np.full(n, i))
        elements += [added, gone]
        marks.append(np.arange(n) >= len(added))
    row, element, gone = map(np.concatenate, (rows, elements, marks))
    row = pa.array(row)
    return pa.RecordBatch.from_arrays(
        [hubs.take(row), ids.take(row), pa.array(element.view(np.int64)), pa.array(gone)],
        ["hub", "id", "element", "gone"],
    )


def pairs_by_differences(members: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """``(a, b)`` of different components, both near a hub, that may be linked.

    ``members`` are ``(hub, id, component, n_a, n_b, both)`` with the sizes of the hub, the
    set and their intersection, ``parts`` the rows of their differences; both are written.
    """
    key = ["hub", "element", "gone"]
    shared = parts.groupBy(*key).agg(F.count("*").alias("among")).filter(F.col("among") > 1)
    shared = materialize(shared, "difference-counts")
    # Elements of one member alone join nothing; they only come first in the order.
    order = parts.join(shared, key).groupBy("hub", "id").agg(
        F.array_sort(F.collect_list(F.struct("gone", "among", "element"))).alias("order"),
        F.count_if(~F.col("gone")).alias("shared_added"),
    )
    members = members.select(
        "hub",
        "id",
        "component",
        (F.col("n_a") + F.col("n_b") - 2 * F.col("both")).alias("n"),
        F.col("n_b").alias("size"),
        F.col("n_a").alias("hub_size"),
        (F.col("n_b") - F.col("both")).alias("n_added"),
    )
    other = 100 - percent
    slack = F.floor(other * F.col("size") / percent)
    least_loose = F.floor(other * (percent * F.col("size") / 100 + F.col("hub_size")) / (100 + percent))
    short = F.greatest(
        F.lit(1), F.ceil((F.col("n") + F.greatest(F.col("n"), least_loose) - slack) / 2)
    )
    # One more than the arithmetic says, against rounding of the quotients above.
    ranked = order.join(members, ["hub", "id"]).select(
        "hub",
        "id",
        "component",
        "n",
        "size",
        (slack + 2).alias("long_prefix"),
        (F.col("n") - short + 2).alias("short_prefix"),
        (F.col("n_added") - F.col("shared_added")).alias("alone"),
        F.posexplode("order"),
    )
    # What only the hub has and this set alone lacks would stand before the shared ones of
    # its kind. Leaving it out brings them forward, which keeps every prefix complete.
    ranked = ranked.select(
        "hub", "id", "component", "n", "size", "long_prefix", "short_prefix",
        (F.col("pos") + F.col("alone")).alias("pos"),
        F.col("col.gone").alias("gone"),
        F.col("col.element").alias("element"),
    ).filter(F.col("pos") < F.greatest("long_prefix", "short_prefix"))
    ranked = materialize(ranked, "ranked-differences")
    long = ranked.filter(F.col("pos") < F.col("long_prefix")).alias("x")
    short_rows = ranked.filter(F.col("pos") < F.col("short_prefix")).alias("y")
    apart = F.col("x.n") + F.col("y.n") - 2 * F.least(
        F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos")
    )
    met = (
        (F.col("x.hub") == F.col("y.hub"))
        & (F.col("x.element") == F.col("y.element"))
        & (F.col("x.gone") == F.col("y.gone"))
        & (F.struct("x.n", "x.id") > F.struct("y.n", "y.id"))
        & (F.col("x.component") != F.col("y.component"))
        & ((100 + percent) * apart <= other * (F.col("x.size") + F.col("y.size")))
    )
    pairs = long.join(short_rows, met).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    return materialize(pairs.distinct(), "difference-pairs")
