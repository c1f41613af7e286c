"""Near duplicates: SimHash fingerprints linked through covering bit masks.

A document's fingerprint has 64 bits: bit ``b`` is set when over half of its shingles' hashes have it set. Two
fingerprints are linked when at most ``radius`` bits differ, and a component is all that links reach.

Covering masks. Give every bit position a vector of ``radius + 1`` bits, and take for each non-zero vector ``v`` the mask of
the positions whose vector has an odd number of bits in common with ``v``. For any ``radius`` differing positions some
``v`` is orthogonal to all their vectors, so the two fingerprints agree on all bits of that mask: every pair within the
radius meets in one of the ``2 ** (radius + 1) - 1`` tables. No pair is missed, whatever the data.

Work per bucket. Equal fingerprints are one row before any table is built. A bucket of few fingerprints is joined with
itself. In a larger one every fingerprint names the points within ``radius / 2`` flips of it among the bits outside the
mask, and those that name a point in common are linked in a star: two fingerprints two flips apart share the point in
between. That is linear in the bucket, loses no link and needs no cap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlake.llm.common import free_name, small_batches
from stintlake.llm.components import components
from stintlake.session import stage

BITS = 64
SEED = 42
_BLOCK = 1 << 16


def fingerprint_of(text: str | None, shingle: int = 3) -> int:
    """The fingerprint as a signed 64-bit number; a text without words has 0."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # bytes: only A-Z change
    if not words:
        return 0
    line = b" ".join(words)
    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts = np.concatenate(([0], spaces + 1))
    ends = np.concatenate((spaces, [len(line)]))
    if len(words) > shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(starts), _BLOCK):
        part = zip(starts[at : at + _BLOCK].tolist(), ends[at : at + _BLOCK].tolist())
        hashes = np.array([digest(line[s:e], SEED) for s, e in part], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<i8")[0])


def fingerprint(text: Column | str, shingle: int = 3) -> Column:
    """Fingerprint column of a text column."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint_of(t, shingle) for t in texts], dtype="int64")

    return run(text)


def covering_masks(radius: int) -> list[int]:
    """One mask of 64 bits for each non-zero vector, as signed numbers; positions take the vectors in turn."""
    size = radius + 1
    vectors = [1 + b % (2**size - 1) for b in range(BITS)]
    masks = [sum(1 << b for b, x in enumerate(vectors) if bin(x & v).count("1") % 2) for v in range(1, 2**size)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _points(value: Column, masks: list[int], which: Column, flips: int) -> Column:
    """All points within ``flips`` flips of ``value`` among the bits outside its table's mask."""
    free = [[1 << b for b in range(63) if not m >> b & 1] + ([-(1 << 63)] if m >= 0 else []) for m in masks]
    bits = F.element_at(F.lit(free), which + 1)
    points = F.array(value)
    for _ in range(flips):
        further = F.flatten(F.transform(points, lambda p: F.transform(bits, lambda b: p.bitwiseXOR(b))))
        points = F.array_distinct(F.concat(points, further))
    return points


def links(prints: DataFrame, radius: int = 2, pair_limit: int = 64) -> DataFrame:
    """Links ``(a, b)``, a < b, whose components are those of all pairs of ``prints.fp`` within ``radius`` bits.

    ``prints`` has distinct fingerprints. A bucket of up to ``pair_limit`` gives its verified pairs; a larger one stars
    around shared points, which join what such pairs join (a star has fewer links than all its pairs). The limit only
    chooses the cheaper of two exact ways; stars need an even radius, otherwise all buckets are joined in pairs.
    """
    masks = covering_masks(radius)
    keyed = prints.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("t", "k"))
    sizes = keyed.groupBy("t", "k").agg(F.count("*").alias("n")).where("n > 1")
    met = keyed.join(sizes, ["t", "k"])
    starred = F.col("n") > pair_limit if radius % 2 == 0 else F.lit(False)
    few = met.where(~starred)
    a, b = few.select("t", "k", F.col("fp").alias("a")), few.select("t", "k", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    pairs = a.join(b, ["t", "k"]).where((F.col("a") < F.col("b")) & near).select("a", "b")
    if radius % 2:
        return pairs.distinct()
    named = met.where(starred).select("fp", "t", "k", F.explode(_points(F.col("fp"), masks, F.col("t"), radius // 2)).alias("p"))
    hubs = named.groupBy("t", "k", "p").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    least = F.array_min("fps")
    stars = hubs.select(least.alias("a"), F.explode("fps").alias("b")).where("a < b")
    return pairs.unionByName(stars).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2, pair_limit: int = 64
) -> DataFrame:
    """One row per row of ``docs``: its id, its ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id reached.

    Null and empty texts, and texts of white space alone, have fingerprint zero and are linked like any other. Texts of
    fewer words than a shingle are one shingle. Repeated rows come back as often as they came. A null id stays null and is
    no one's component id unless a component has no other. Other columns of ``docs`` are not looked at.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    marked = stage(rows.select("doc_id", fingerprint("text", shingle).alias("fp")), "fingerprints")
    prints = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    reached = components(links(prints.select("fp"), radius, pair_limit))
    rooted = prints.join(reached.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    rooted = stage(rooted, "roots")
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.join(smallest, "root").select("fp", "component_id")
    return marked.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that stay when each component keeps its smallest id, with all their columns.

    Rows that repeat a kept id are reduced to one of them. Rows without an id cannot be told apart and stay. Texts, which
    may be null, empty or of any length, move once, to the kept ids; columns may have any names; an empty table stays empty.
    """
    found = near_duplicates(docs, id_col, **options)
    mark = free_name(docs, "_kept")
    kept = stage(found.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(mark)).distinct(), "kept")
    # the join leaves rows by id, so that repeats are next to each other
    joined = docs.join(kept, F.col(id_col) == F.col(mark), "left_semi").dropDuplicates([id_col])
    return joined.unionByName(docs.where(F.col(id_col).isNull()))
