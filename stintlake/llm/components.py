"""Connected components of a link table by alternating stars, without gathering a component anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest node it knows."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie every node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))  # v < u
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    others = down.join(least, "u").where("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return others.unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (a < b): root is the smallest node reached.

    Each round is written to the shared folder, so a lost executor costs one round at most. The number of rounds grows
    with the logarithm of the longest chain; a round's rows never outnumber the links.
    """
    now, state = stage(edges.select("a", "b").distinct(), "links"), None
    while True:
        mark = F.xxhash64("a", "b")
        seen = now.agg(F.count("*"), F.sum(mark % 1_000_003), F.bit_xor(mark)).first()
        if seen == state or not seen[0]:
            break
        state = seen
        now = stage(_small_star(_large_star(now)), "links")
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )
