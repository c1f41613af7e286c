"""The trie of all turn sequences, by a van Emde Boas recursion: cut at half the depth, solve both halves, graft.

A trie of height ``2 ** j`` is cut at half its height into an upper trie and the forests below the cut. What a sequence has
above the cut is one block of ``2 ** (j - 1)`` turns; its name is the digest of its halves' names, so the blocks of all
levels are named from the leaves up. From the top down every cut prefix then gets the name of its block behind the prefix
that its trie hangs from, and the halves of all tries of a level are cut in parallel, down to single nodes. A node is known
by its smallest member and its depth once its members are counted.

Totals go up again: level by level the root of every lower trie, whose total is complete within its height, is grafted on
the path to the root of its upper trie, which its smallest member has taken. All of it is aggregations and joins on
(sequence, place) or on nodes: the number of levels grows with the logarithm of the longest sequence, and neither a
sequence nor the members of a node are ever gathered. Names are SHA-256 digests; equal digests are taken for equal turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlake.functions.ordered import OrderedGroups
from stintlake.session import stage

#: Ids in one piece of the line that a node's digest is made of.
CHUNK = 50_000
_NOTHING = hashlib.sha256(b"").hexdigest()


def _digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def turns_of(conversations: DataFrame, id_col: str = "conv_id", order_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv, pos`` (from 0), ``name`` (digest of role and text) and ``weight`` (code points of the text), staged.

    Turns are ordered by ``order_col`` (null first), then role, then text. Null roles and texts are empty; rows without an
    id belong to no conversation. Repeated rows are turns of their own.
    """
    rows = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"),
        F.col(order_col).alias("turn"),
        F.coalesce(role_col, F.lit("")).alias("role"),
        F.coalesce(text_col, F.lit("")).alias("text"),
    )
    numbered = OrderedGroups(rows, ["conv"], ["turn", "role", "text"]).running(sums={"pos": F.lit(1).cast("long")}).result()
    # the role's length first, so that no other role and text read the same
    line = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary")
    return stage(numbered.select("conv", (F.col("pos") - 1).alias("pos"), _digest(line).alias("name"), F.length("text").cast("long").alias("weight")), "turns")


def with_shared_openings(turns: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of the one whose id is the next multiple of ``every`` below.

    Conversation ``c`` opens with the first ``crc32(c) % most`` turns of conversation ``c - c % every`` (all if it has
    fewer, none if there is none) in place of as many of its own, if it has them. Gives the turns and ``conv, n`` with the
    new number of turns, which may be 0.
    """
    conv = F.col("conv")
    lengths = turns.groupBy("conv").agg(F.count("*").alias("own"))
    taken = (F.crc32(conv.cast("string").cast("binary")) % most).alias("h")
    lengths = stage(lengths.select("conv", "own", (conv - conv % every).alias("base"), taken), "lengths")
    bases = lengths.where(conv % every == 0).select(conv.alias("base"), F.col("own").alias("of_base"))
    convs = lengths.join(bases, "base", "left").withColumn("k", F.least("h", F.coalesce("of_base", F.lit(0))))
    convs = stage(convs.select("conv", "base", "h", "k", (F.col("k") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n")), "convs")
    opening = turns.where((conv % every == 0) & (F.col("pos") < most)).withColumnRenamed("conv", "base")
    shared = convs.where("k > 0").join(opening, "base").where("pos < k").select("conv", "pos", "name", "weight")
    moved = turns.join(convs, "conv").where("pos >= h").select("conv", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "name", "weight")
    return stage(shared.unionByName(moved), "rebuilt"), convs.select("conv", "n")


def _blocks(turns: DataFrame, levels: int) -> list[DataFrame]:
    """For each level the full, aligned blocks of ``2 ** level`` turns: ``conv, b, name`` and the ``weight`` of the last turn."""
    found = [turns.select("conv", F.col("pos").alias("b"), "name", "weight")]
    for _ in range(1, levels):
        right = F.col("b") % 2 == 1
        halves = found[-1].groupBy("conv", F.shiftright("b", 1).alias("b")).agg(
            F.max(F.when(~right, F.col("name"))).alias("left"),
            F.max(F.when(right, F.col("name"))).alias("right"),
            F.max(F.when(right, F.col("weight"))).alias("weight"),
        )
        full = halves.where("right is not null")
        found.append(stage(full.select("conv", "b", _digest(F.col("left"), F.col("right")).alias("name"), "weight"), "named"))
    return found


def _memberships(blocks: list[DataFrame], convs: DataFrame) -> DataFrame:
    """``conv, n, p, prefix, weight``: the name of every conversation's first p turns, for p from 0 to n."""
    parts = convs.select("conv", "n", F.lit(0).cast("long").alias("s"), F.lit(b"").alias("prefix"), F.lit(0).cast("long").alias("weight"))
    for upper in reversed(blocks):
        above = upper.where("b % 2 = 0").select(
            F.col("conv").alias("_c"), F.shiftright("b", 1).alias("_s"), F.col("name").alias("_name"), F.col("weight").alias("_w")
        )
        met = parts.join(above, (F.col("conv") == F.col("_c")) & (F.col("s") == F.col("_s")), "left")
        same = F.struct((F.col("s") * 2).alias("s"), "prefix", "weight")
        cut = F.struct((F.col("s") * 2 + 1).alias("s"), _digest(F.col("prefix"), F.col("_name")).alias("prefix"), F.col("_w").alias("weight"))
        both = F.when(F.col("_name").isNull(), F.array(same)).otherwise(F.array(same, cut))
        parts = met.select("conv", "n", F.explode(both).alias("_p")).select("conv", "n", "_p.*")
    return parts.withColumnRenamed("s", "p")


def _line_digests(ends: DataFrame) -> DataFrame:
    """``node, p, sha``: SHA-256 of the ids ``conv`` of each node in ascending order, with commas between.

    The ids are dealt out and sorted by ranges and joined into pieces of a line; only the pieces of a node meet in one task,
    which reads them one after the other, as the digest must.
    """

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held, done = None, [], []
        for batch in batches:
            for node, p, conv in zip(batch["node"].tolist(), batch["p"].tolist(), batch["conv"].tolist()):
                if held and ((node, p) != at or len(held) >= CHUNK):
                    done.append((*at, held[0], ",".join(map(str, held))))
                    held = []
                at = (node, p)
                held.append(conv)
            yield pd.DataFrame(done, columns=["node", "p", "first", "line"])
            done = []
        if held:
            yield pd.DataFrame([(*at, held[0], ",".join(map(str, held)))], columns=["node", "p", "first", "line"])

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state = None, None
        for batch in batches:
            done = []
            for node, p, line in zip(batch["node"].tolist(), batch["p"].tolist(), batch["line"].tolist()):
                if (node, p) == at:
                    state.update(b",")
                else:
                    if at is not None:
                        done.append((*at, state.hexdigest()))
                    at, state = (node, p), hashlib.sha256()
                state.update(line.encode())
            yield pd.DataFrame(done, columns=["node", "p", "sha"])
        if at is not None:
            yield pd.DataFrame([(*at, state.hexdigest())], columns=["node", "p", "sha"])

    dealt = ends.select("node", "p", "conv").repartitionByRange("node", "p", "conv").sortWithinPartitions("node", "p", "conv")
    lines = dealt.mapInPandas(pieces, "node long, p long, first long, line string")
    met = lines.repartition("node", "p").sortWithinPartitions("node", "p", "first")
    return met.mapInPandas(digests, "node long, p long, sha string")


def _grafted(own: DataFrame, paths: DataFrame, levels: int) -> list[DataFrame]:
    """What to add to ``node, p, leaves, saved`` of ``own`` so that every node has the total of its subtree.

    On level j the nodes at the cuts have the totals of the tries below, of height ``2 ** (j - 1)``; each is added to the
    nodes above it in the upper trie.
    """
    sums = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
    found = [own]
    for level in range(1, levels + 1):
        half = 1 << (level - 1)
        at_cut = [t.where(F.col("p") % (2 * half) == half) for t in found]
        roots = reduce(DataFrame.unionByName, at_cut).groupBy("node", "p").agg(*sums)
        spread = roots.select(
            F.col("node").alias("conv"), F.explode(F.sequence(F.col("p") - half, F.col("p") - 1)).alias("p"), "leaves", "saved"
        )
        above = paths.where(F.col("p") % (2 * half) < half).select("conv", "p", "node")
        found.append(stage(spread.join(above, ["conv", "p"]).groupBy("node", "p").agg(*sums), "grafts"))
    return found


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the trie of all sequences, from ``conv, pos, name, weight`` and ``conv, n`` (n may be 0).

    A node is (``conv_id``, ``depth``), its smallest member and its number of turns; ``parent_conv_id`` (null at the root),
    ``n_convs`` members, ``n_children``, ``n_leaves`` (nodes without children in its subtree, itself included),
    ``saved_tokens`` (sum over its subtree of members but one times the weight of the last turn) and ``ends_sha256`` of the
    members that end here. No sequences, no rows; sequences without turns are members of the root alone.
    """
    longest = convs.agg(F.max("n")).first()[0] or 0
    levels = int(longest).bit_length()
    members = stage(_memberships(_blocks(turns, levels) if levels else [], convs), "members")
    named = members.groupBy("p", "prefix").agg(
        F.min("conv").alias("node"), F.count("*").alias("n_convs"), F.max("weight").alias("weight"), F.max("n").alias("deepest")
    )
    named = stage(named, "nodes")
    paths = members.join(named.select("p", "prefix", "node"), ["p", "prefix"]).select("conv", "n", "p", "node")
    paths = stage(paths, "paths")
    leaf = (F.col("deepest") == F.col("p")).cast("long")
    own = named.select("node", "p", "n_convs", leaf.alias("leaves"), ((F.col("n_convs") - 1) * F.col("weight")).alias("saved"))
    above = paths.select(F.col("conv").alias("node"), (F.col("p") + 1).alias("p"), F.col("node").alias("parent"))
    own = stage(own.join(above, ["node", "p"], "left"), "own")
    grafts = _grafted(own.select("node", "p", "leaves", "saved"), paths, levels)[1:]
    children = own.where("parent is not null").select(F.col("parent").alias("node"), (F.col("p") - 1).alias("p"), F.lit(1).cast("long").alias("children"))
    ends = _line_digests(paths.where("p = n"))
    everything = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [own, children, ends, *grafts])
    found = everything.groupBy("node", "p").agg(
        F.max("parent").alias("parent_conv_id"),
        F.max("n_convs").alias("n_convs"),
        F.count("children").alias("n_children"),
        F.sum("leaves").alias("n_leaves"),
        F.sum("saved").alias("saved_tokens"),
        F.coalesce(F.max("sha"), F.lit(_NOTHING)).alias("ends_sha256"),
    )
    return found.withColumnsRenamed({"node": "conv_id", "p": "depth"})


def conversation_trie(conversations: DataFrame, every: int = 100, most: int = 6, **columns: str) -> DataFrame:
    """``prefix_trie`` of ``conversations`` with shared openings (``turns_of`` and ``with_shared_openings`` say how).

    Null orders come first, null roles and texts are empty, rows without an id are left out; an empty table has no nodes.
    Texts of any length count by their digest and their code points; other columns are not looked at.
    """
    return prefix_trie(*with_shared_openings(turns_of(conversations, **columns), every, most))
