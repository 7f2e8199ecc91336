"""The trie of conversation prefixes by ROLLUP over positional turn ids.

A conversation is cut into blocks of a few turns, one row per block with a column per
position. ``GROUP BY prior, ROLLUP(t1 .. tn)`` then counts all prefixes of a block at
once, and ``grouping_id`` tells their lengths. ``prior`` is the node that a conversation
reached in the block before, named by its smallest member: at one depth no two nodes
have the same. A second rollup over the nodes sums their subtrees, from the last block
to the first. A conversation that is alone in its node has no more to share; its other
turns are a chain whose nodes follow without a rollup, so there are as many rounds as the
longest shared prefix has blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflow.llm.running import running_total
from odflow.sources.scratch import materialize

BLOCK = 8
DONORS, SHARED = 20, 4
NODE = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
]


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``(conv_id, pos, turn_id, words)`` with positions from 1.

    Rows go by turn, null first, and by a hash of role and text in a turn. Positions are
    running numbers over slices, so a conversation with very many turns is many tasks.
    Only the digest of a turn goes on, not its text.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.coalesce(F.col("turn").cast("bigint"), F.lit(-(1 << 63))).alias("turn"),
        F.col("turn").isNotNull().alias("set"),
        F.unhex(digest).alias("turn_id"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"),
        F.lit(1).alias("one"),
    )
    numbered = running_total(rows, ["turn", "set", "turn_id"], "one", "pos", ["conv_id"])
    return materialize(numbered.select("conv_id", "pos", "turn_id", "words"), "numbered-turns")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv_id, pos, turn_id, words)`` and ``(conv_id, n_turns)`` after rebuilding.

    Conversation c gets the first h turns of conversation c - c % 20, then its own after
    the first h; h is the checksum of c modulo 4. At most three turns of a donor are
    ever joined, as one row.
    """
    own = numbered_turns(turns)
    shared = (F.crc32(F.col("conv_id").cast("string")) % SHARED).cast("int")
    sizes = own.groupBy("conv_id").agg(F.count("*").alias("n_own"))
    first = own.filter((F.col("conv_id") % DONORS == 0) & (F.col("pos") < SHARED))
    donors = first.groupBy(F.col("conv_id").alias("donor")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "turn_id", "words"))).alias("given")
    )
    wanted = sizes.select(
        "conv_id",
        "n_own",
        shared.alias("h"),
        (F.col("conv_id") - F.col("conv_id") % DONORS).alias("donor"),
    )
    given = F.coalesce(F.slice("given", F.lit(1), F.col("h")), F.array())
    convs = wanted.join(donors, "donor", "left").select(
        "conv_id",
        given.alias("given"),
        (F.size(given) + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("n_turns"),
    )
    convs = materialize(convs, "rebuilt-conversations")
    head = convs.select("conv_id", F.inline("given"))
    # The donor's turns take the first places: min(h, its turns) of them.
    counts = convs.select("conv_id", F.size("given").alias("n_given"))
    tail = own.filter(F.col("pos") > shared).join(counts, "conv_id")
    tail = tail.withColumn("pos", F.col("pos") - shared + F.col("n_given"))
    both = head.unionByName(tail.select("conv_id", "pos", "turn_id", "words"))
    return both, convs.select("conv_id", "n_turns")


def _columns(prefix: str, block: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(1, block + 1)]


def blocks(turns: DataFrame, convs: DataFrame, block: int) -> DataFrame:
    """One row per conversation and block: turn ids ``t1 ..``, words ``w1 ..``, sizes.

    A conversation without turns has an empty first block.
    """
    place = (F.col("pos") - 1) % block
    rows = turns.groupBy("conv_id", ((F.col("pos") - 1) / block).cast("int").alias("block")).agg(
        *(F.max(F.when(place == i, F.col("turn_id"))).alias(f"t{i + 1}") for i in range(block)),
        *(F.max(F.when(place == i, F.col("words"))).alias(f"w{i + 1}") for i in range(block)),
    )
    n = "n_turns"
    bare = convs.filter(F.col(n) == 0).select("conv_id", F.lit(0).alias("block"))
    return materialize(rows.join(convs, "conv_id").unionByName(
        bare.select(
            "*",
            *(F.lit(None).cast("binary").alias(c) for c in _columns("t", block)),
            *(F.lit(None).cast("bigint").alias(c) for c in _columns("w", block)),
            F.lit(0).cast("bigint").alias(n),
        )
    ), "blocks")


def _at(columns: list[str], level: Column) -> Column:
    return F.element_at(F.array(*columns), level)


def _prefixes(rows: DataFrame, number: int, block: int) -> DataFrame:
    """The nodes of one block from its rows, by one rollup.

    The empty prefix is a node only in the first block; later it is ``prior`` itself.
    """
    t, w = _columns("t", block), _columns("w", block)
    spark = rows.sparkSession
    counted = spark.sql(
        f"""
        SELECT prior, {", ".join(t)}, {block} - bit_count(grouping_id()) AS level,
          count(*) AS n_convs, min(conv_id) AS conv_id,
          count_if(n_turns <= {number * block} + {block} - bit_count(grouping_id())) AS n_over,
          {", ".join(f"max({c}) AS {c}" for c in w)}
        FROM {{rows}} GROUP BY prior, ROLLUP({", ".join(t)})
        """,
        rows=rows,
    )
    level = F.col("level")
    real = F.when(level == 0, number == 0).otherwise(_at(t, F.greatest(level, F.lit(1))).isNotNull())
    words = F.when(level == 0, 0).otherwise(_at(w, F.greatest(level, F.lit(1))))
    return counted.filter(real).select(
        "prior",
        *t,
        level.cast("int").alias("level"),
        "conv_id",
        "n_convs",
        # All members that hold the whole prefix and are over end in this node.
        (F.col("n_over") == F.col("n_convs")).alias("leaf"),
        ((F.col("n_convs") - 1) * words).alias("saved"),
    )


def _subtrees(nodes: DataFrame, block: int) -> DataFrame:
    """Sums over the subtree of every node of a block, by a second rollup.

    The group of a prefix holds its node and all below: the node has the most members.
    """
    t = _columns("t", block)
    level = f"({block} - bit_count(grouping_id()))"
    summed = nodes.sparkSession.sql(
        f"""
        SELECT prior, {", ".join(t)}, {level} AS level, min(conv_id) AS conv_id,
          max(n_convs) AS n_convs, sum(n_below) + sum(leaf) AS n_leaves,
          sum(saved) AS saved_tokens,
          count_if(level = {level} + 1) + max(if(level = {level}, n_next, 0)) AS n_children
        FROM {{nodes}} GROUP BY prior, ROLLUP({", ".join(t)})
        """,
        nodes=nodes.withColumn("leaf", F.col("leaf").cast("bigint")),
    )
    real = (F.col("level") == 0) | _at(t, F.greatest("level", F.lit(1))).isNotNull()
    return summed.filter(real)


def _path_key(t: list[str], drop_last: bool) -> Column:
    """Digest of the path within a block, with or without its last turn."""
    level = F.col("level") - (1 if drop_last else 0)
    known = [F.when(level >= i + 1, F.hex(c)).otherwise("") for i, c in enumerate(t)]
    return F.md5(F.concat_ws("/", F.col("prior").cast("string"), *known))


def _with_parents(summed: DataFrame, number: int, block: int) -> DataFrame:
    """Nodes of a block with the smallest member of their parent.

    The parent of a first turn is ``prior``, which needs no join: it may have very many
    children. The others are joined on written tables, where a busy parent can be split.
    """
    t = _columns("t", block)
    key = summed.select(
        "*", _path_key(t, False).alias("path"), _path_key(t, True).alias("parent_path")
    )
    key = materialize(key, f"trie-block-{number}")
    parents = key.filter((F.col("level") > 0) & (F.col("level") < block)).select(
        F.col("path").alias("parent_path"), F.col("conv_id").alias("parent_conv_id")
    )
    deep = key.filter(F.col("level") > 1).join(parents, "parent_path")
    first = key.filter(F.col("level") == 1).withColumn("parent_conv_id", F.col("prior"))
    root = key.filter(F.col("level") == 0).withColumn("parent_conv_id", F.lit(None).cast("bigint"))
    tops = first.unionByName(root) if number == 0 else first
    return deep.unionByName(tops).select(
        "conv_id",
        (F.col("level") + number * block).cast("bigint").alias("depth"),
        *NODE[2:],
    )


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined ids of each node, read in order as a stream."""
    names = ["conv_id", "depth", "ends_sha256"]
    now, digest = None, None

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else ((), (), ())
        types = [pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, types, strict=True)], names
        )

    for batch in batches:
        done = []
        for conv, depth, member in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now != (conv, depth):
                if now is not None:
                    done.append((*now, digest.hexdigest()))
                now, digest = (conv, depth), hashlib.sha256(str(member).encode())
            else:
                digest.update(f",{member}".encode())
        if done:
            yield batch_of(done)
    if now is not None:
        yield batch_of([(*now, digest.hexdigest())])


def prefix_trie(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per node of the trie of rebuilt conversations; see :func:`rebuilt`.

    ``conv_id`` is the smallest member, ``n_convs`` the number of members, ``n_leaves`` and
    ``saved_tokens`` are sums over the subtree, ``ends_sha256`` is the hash of the ids that
    end in the node. Null roles and texts are empty, a null turn comes first, turns that
    repeat a number go by a hash of role and text, repeated rows are turns of their own.
    Rows with a null ``conv_id`` belong to no conversation and are left out. Without
    conversations there is no root and no row. Other columns are ignored.
    """
    rows, convs = rebuilt(turns)
    convs = materialize(convs, "conversation-sizes")
    cut = blocks(rows, convs, block)
    t = _columns("t", block)
    root, most = convs.agg(F.min("conv_id"), F.max("n_turns")).first()
    # The root's members are all; the smallest one names it, like any other node.
    now = cut.filter(F.col("block") == 0).withColumn("prior", F.lit(root).cast("bigint"))
    rounds, ends, tails = [], [], []
    number = 0
    while True:
        nodes = materialize(_prefixes(now, number, block), f"trie-nodes-{number}")
        rounds.append(nodes)
        last = nodes.filter(F.col("level") == block).select(
            "prior", *t, F.col("conv_id").alias("_node"), "n_convs"
        )
        reached = number * block
        ended = now.filter(F.col("n_turns") <= reached + block)
        ends.append((ended, nodes, number))
        if (most or 0) <= reached + block:
            break
        # Ids of turns are never null here, so plain equality joins the paths.
        going = now.filter(F.col("n_turns") > reached + block)
        going = going.select("conv_id", "prior", *t).join(last, ["prior", *t])
        going = materialize(going.select("conv_id", "_node", "n_convs"), f"trie-going-{number}")
        alone = going.filter(F.col("n_convs") == 1)
        tails.append((alone.select("conv_id"), number + 1))
        shared = going.filter(F.col("n_convs") > 1).select("conv_id", F.col("_node").alias("prior"))
        number += 1
        now = materialize(
            cut.filter(F.col("block") == number).join(shared, "conv_id"), f"trie-rows-{number}"
        )
        if now.isEmpty():
            break
    return _finish(rounds, ends, tails, convs, block)


def _tail_nodes(tails: list, convs: DataFrame, block: int) -> DataFrame | None:
    """Nodes of the conversations that went on alone, and the depth where that began."""
    parts = [
        alone.select(F.col("conv_id"), F.lit(number * block).cast("bigint").alias("from_depth"))
        for alone, number in tails
    ]
    if not parts:
        return None
    alone = parts[0]
    for part in parts[1:]:
        alone = alone.unionByName(part)
    return materialize(alone.join(convs, "conv_id"), "trie-tails")


def _finish(
    rounds: list[DataFrame], ends: list, tails: list, convs: DataFrame, block: int
) -> DataFrame:
    t = _columns("t", block)
    alone = _tail_nodes(tails, convs, block)
    zero = F.lit(0).cast("bigint")
    below = None  # of each last node of a block: leaves, saved tokens and children behind
    out = []
    for number in range(len(rounds) - 1, -1, -1):
        nodes = rounds[number].withColumns({"n_below": zero, "n_next": zero})
        reached = (number + 1) * block
        carried = [] if below is None else [below]
        if alone is not None:
            carried.append(
                alone.filter(F.col("from_depth") == reached).select(
                    F.col("conv_id").alias("_node"),
                    F.lit(1).cast("bigint").alias("_leaves"),
                    zero.alias("_saved"),
                    F.lit(1).cast("bigint").alias("_children"),
                )
            )
        if carried:
            more = carried[0] if len(carried) == 1 else carried[0].unionByName(carried[1])
            here = (F.col("conv_id") == F.col("_node")) & (F.col("level") == block)
            nodes = (
                rounds[number]
                .join(materialize(more, f"trie-below-{number}"), here, "left")
                .withColumns(
                    {
                        "n_below": F.coalesce("_leaves", zero),
                        "n_next": F.coalesce("_children", zero),
                        "saved": F.col("saved") + F.coalesce("_saved", zero),
                    }
                )
                .drop("_node", "_leaves", "_saved", "_children")
            )
        summed = materialize(_subtrees(nodes, block), f"trie-sums-{number}")
        out.append(_with_parents(summed, number, block))
        below = summed.filter(F.col("level") == 0).select(
            F.col("prior").alias("_node"),
            F.col("n_leaves").alias("_leaves"),
            F.col("saved_tokens").alias("_saved"),
            F.col("n_children").alias("_children"),
        )
    ended = []
    for rows, nodes, number in ends:
        # The node in which a conversation ends has its whole path and its length.
        size = (F.col("n_turns") - number * block).cast("int")
        key = rows.select("conv_id", "prior", *t, size.alias("level"))
        named = nodes.select("prior", *t, "level", F.col("conv_id").alias("_node"))
        same = [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in t]
        met = (F.col("x.prior") == F.col("y.prior")) & (F.col("x.level") == F.col("y.level"))
        for test in same:
            met = met & test
        ended.append(
            key.alias("x")
            .join(named.alias("y"), met)
            .select(
                F.col("_node").alias("conv_id"),
                (F.col("x.level") + number * block).cast("bigint").alias("depth"),
                F.col("x.conv_id").alias("member"),
            )
        )
    if alone is not None:
        places = F.explode(F.sequence(F.col("from_depth") + 1, F.col("n_turns")))
        out.append(
            alone.select("conv_id", "n_turns", places.alias("depth")).select(
                "conv_id",
                "depth",
                F.col("conv_id").alias("parent_conv_id"),
                F.lit(1).cast("bigint").alias("n_convs"),
                (F.col("depth") < F.col("n_turns")).cast("bigint").alias("n_children"),
                F.lit(1).cast("bigint").alias("n_leaves"),
                zero.alias("saved_tokens"),
            )
        )
        ended.append(
            alone.select("conv_id", F.col("n_turns").alias("depth"), F.col("conv_id").alias("member"))
        )
    found, members = out[0], ended[0]
    for part in out[1:]:
        found = found.unionByName(part)
    for part in ended[1:]:
        members = members.unionByName(part)
    # A hash of all members is a stream by nature; it is read in order, never held.
    hashes = (
        members.repartition("conv_id", "depth")
        .sortWithinPartitions("conv_id", "depth", "member")
        .mapInArrow(_hashes, "conv_id bigint, depth bigint, ends_sha256 string")
    )
    hashes = materialize(hashes, "trie-ends")
    found = materialize(found.select(*NODE), "trie-found")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return found.join(hashes, ["conv_id", "depth"], "left").select(
        *NODE, F.coalesce("ends_sha256", empty).alias("ends_sha256")
    )
