"""Codes of vectors by their nearest codebook entries, in whole numbers, searched in the Walsh-Hadamard domain.

Vectors become integers and are cut into equal parts with a codebook each. To find the entry nearest to a part, both are
padded with zeros to a power of two and transformed by the integer Walsh-Hadamard transform, which scales squared distances by
that power. Squared differences are added up in sequency order, a few coefficients at a time: what has been added is a
lower bound, and an entry above the full distance of the one that led at first is dropped. What is left at the end has
exact distances; no floating point is involved, and ties go to the entry with the lowest index.

Spark scans the vectors once a round; a task returns sums and counts by entry. The codebooks (parts times entries) are all
that passes through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.functions.joins import join_small
from stintlake.llm.common import small_batches
from stintlake.session import stage

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Vectors handled at a time, coefficients added between two looks at the bound, and what part of all entries are few.
_ROWS, _STEP, _FEW = 256, 4, 8
#: Bits of a limb, where integers are too wide for sums of 64 bits.
_LIMBS = 30


@lru_cache(maxsize=16)
def sequency(size: int) -> np.ndarray:
    """Rows of the natural-order transform by their number of sign changes: the bit-reversed Gray code."""
    bits, order = size.bit_length() - 1, []
    for s in range(size):
        gray = s ^ s >> 1
        order.append(int(format(gray, f"0{bits}b")[::-1], 2) if bits else 0)
    return np.array(order)


def transform(rows: np.ndarray) -> np.ndarray:
    """Integer Walsh-Hadamard transform of each row, zero-padded to a power of two, in sequency order."""
    n, width = rows.shape
    size = 1 << max(0, width - 1).bit_length()
    x = np.zeros((n, size), rows.dtype)
    x[:, :width] = rows
    half = 1
    while half < size:
        pairs = x.reshape(n, size // (2 * half), 2, half)
        x = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(n, size)
        half *= 2
    return x[:, sequency(size)]


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each row's nearest entry, the lowest of equally near ones, and its squared distance."""
    index, distance = np.zeros(len(rows), np.int64), np.zeros(len(rows), rows.dtype)
    e, whole = transform(entries), transform(rows)
    across, size = np.ascontiguousarray(e.T), e.shape[1]
    for begin in range(0, len(rows), _ROWS):
        y = whole[begin : begin + _ROWS]
        part, apart = np.zeros((len(y), len(e)), rows.dtype), np.empty((len(y), len(e)), rows.dtype)
        bound, k = None, 0
        while True:  # all entries at a time, until few are left
            for k in range(k, min(k + _STEP, size)):
                np.subtract(y[:, k : k + 1], across[k], out=apart)
                part += np.multiply(apart, apart, out=apart)
            k += 1
            if bound is None:
                bound = ((y - e[part.argmin(axis=1)]) ** 2).sum(axis=1)
            near = part <= bound[:, None]
            if k >= size or np.count_nonzero(near) * _FEW <= near.size:
                break
        at, entry = np.nonzero(near)
        so_far = part[at, entry]
        for k in range(k, size, _STEP):
            so_far = so_far + ((y[at, k : k + _STEP] - e[entry, k : k + _STEP]) ** 2).sum(axis=1)
            left = so_far <= bound[at]
            at, entry, so_far = at[left], entry[left], so_far[left]
        # entries come in order by row, and every row has one left
        least = np.minimum.reduceat(so_far, np.searchsorted(at, np.arange(len(y))))
        hit = np.flatnonzero(so_far == least[at])
        index[begin : begin + len(y)] = entry[hit[np.searchsorted(at[hit], np.arange(len(y)))]]
        distance[begin : begin + len(y)] = least // size
    return index, distance


class Shape:
    """How wide parts are and whether their integers leave room for squares in 64 bits."""

    def __init__(self, width: int, largest: float, parts: int, scale: int):
        self.parts, self.scale = parts, scale
        self.part = -(-width // parts)
        self.bits = max(1, int(largest).bit_length() + scale.bit_length()) if largest else 1
        padded = 1 << max(0, self.part - 1).bit_length()
        self.plain = 2 * (self.bits + 1) + 2 * padded.bit_length() <= 62
        self.limbs = 1 if self.plain else -(-(self.bits + 2) // _LIMBS)

    def integers(self, vectors: pa.Array) -> np.ndarray:
        """Rows of ``floor(scale * x)``, short vectors padded with zeros; Python's integers where 64 bits are too few."""
        ends = vectors.offsets.to_numpy().astype(np.int64)
        flat = vectors.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
        sizes, ends = np.diff(ends), ends - ends[0]
        if self.plain:
            scaled = np.floor(flat.astype(np.float64) * self.scale).astype(np.int64)
        else:
            exact = (float(x).as_integer_ratio() for x in flat)
            scaled = np.array([a * self.scale // b for a, b in exact] + [None], object)[:-1]
        out = np.zeros((len(sizes), self.part * self.parts), scaled.dtype)
        if not self.plain:
            out[:] = 0
        rows = np.repeat(np.arange(len(sizes)), sizes)
        out[rows, np.arange(len(scaled)) - np.repeat(ends[:-1], sizes)] = scaled
        return out

    def split(self, sums: np.ndarray) -> np.ndarray:
        """Each integer in limbs of ``_LIMBS`` bits, lowest first, the last one signed."""
        if self.limbs == 1:
            return sums.astype(np.int64)[:, :, None]
        mask = (1 << _LIMBS) - 1
        parts = [[[(int(v) >> (_LIMBS * k)) & mask if k < self.limbs - 1 else int(v) >> (_LIMBS * k) for k in range(self.limbs)] for v in row] for row in sums]
        return np.array(parts, np.int64)


def _assigned(shape: Shape, books: list[np.ndarray], vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Integers of the vectors, an index for each part, and the summed squared distance."""
    whole = shape.integers(vectors)
    codes, error = np.zeros((len(whole), shape.parts), np.int64), np.zeros(len(whole), whole.dtype)
    for k, book in enumerate(books):
        codes[:, k], distance = nearest(whole[:, k * shape.part : (k + 1) * shape.part], book)
        error = error + distance
    return whole, codes, error


def _round(kept: DataFrame, shape: Shape, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round: every used entry is the floor of its parts' mean."""
    shared = kept.sparkSession.sparkContext.broadcast(books)
    entries, limbs = len(books[0]), shape.limbs

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = shared.value
        sums = np.zeros((shape.parts * entries, shape.part, limbs), np.int64)
        counts = np.zeros(shape.parts * entries, np.int64)
        for batch in batches:
            whole, codes, _ = _assigned(shape, mine, batch.column("vector"))
            for k in range(shape.parts):
                order = np.argsort(codes[:, k], kind="stable")
                used, first = np.unique(codes[order, k], return_index=True)
                if len(used):
                    grouped = np.add.reduceat(whole[order, k * shape.part : (k + 1) * shape.part], first, axis=0)
                    sums[k * entries + used] += shape.split(grouped)
                    counts[k * entries + used] += np.diff(np.append(first, len(codes)))
        at = np.flatnonzero(counts)
        flat = pa.array(sums[at].reshape(len(at), -1).tolist(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at]), flat], names=["entry", "n", "sums"])

    parts = kept.select("vector").mapInArrow(partial, "entry long, n long, sums array<long>")
    totals = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(shape.part * limbs)]
    fresh = [b.copy() for b in books]
    for row in parts.groupBy("entry").agg(F.sum("n").alias("n"), *totals).collect():  # a row per used entry
        k, entry = divmod(row["entry"], entries)
        for i in range(shape.part):
            value = sum(row[f"s{i * limbs + j}"] << (_LIMBS * j) for j in range(limbs))
            fresh[k][entry, i] = value // row["n"]
    return fresh


def compress(
    table: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> DataFrame:
    """Per kept row: ``vec_id``, ``code`` (two hex digits a part), ``error``, ``label_error`` and ``codebooks_sha256``.

    Rows whose vector is null or holds null or non-finite components are left out. A component becomes
    ``floor(scale * x)``. Vectors shorter than the longest, or than a multiple of ``parts``, count as filled up with
    zeros. Codebooks start from the smallest ids, each id once (of several vectors under one id the smallest); rows
    without an id are coded, but start no entry, and with no id at all there is nothing to code by. Entries that no part
    chose stay. Repeated rows count and come back as often as they are there. An error past 64 bits is null. No rows, no
    result; other columns are not looked at.
    """
    spark = table.sparkSession
    small_batches(spark, rows=2048)
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = table.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"), F.col(label_col).alias("label"))
    kept = kept.where(F.col("vector").isNotNull() & ~bad)
    size = F.aggregate("vector", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x.cast("double"))))
    seen = kept.agg(F.max(F.size("vector")), F.max(size)).first()
    shape = Shape(seen[0] or 0, seen[1] or 0.0, parts, scale)
    first = kept.where("vec_id is not null").select("vec_id").distinct().orderBy("vec_id").limit(entries)
    start = kept.join(F.broadcast(first), "vec_id").groupBy("vec_id").agg(F.min("vector").alias("vector")).orderBy("vec_id").collect()
    kind = dict(kept.dtypes)["vector"]
    kind = pa.float32() if kind == "array<float>" else pa.float64()
    whole = shape.integers(pa.array([r["vector"] for r in start], pa.list_(kind)))
    books = [np.ascontiguousarray(whole[:, k * shape.part : (k + 1) * shape.part]) for k in range(parts)]
    usable = bool(start) and shape.part > 0
    if usable:
        for _ in range(rounds):
            books = _round(kept, shape, books)
    line = ",".join(str(int(v)) for book in books for entry in book for v in entry)
    shared = spark.sparkContext.broadcast(books)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if usable:
                _, codes, error = _assigned(shape, shared.value, batch.column("vector"))
                text = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
                errors = [int(e) if e < 1 << 63 else None for e in error.tolist()]
            else:
                text, errors = [""] * n, [0] * n
            columns = [batch.column("vec_id"), batch.column("label"), pa.array(text, pa.string()), pa.array(errors, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    types = dict(kept.dtypes)
    found = kept.mapInArrow(coded, f"vec_id {types['vec_id']}, label {types['label']}, code string, error long")
    found = stage(found, "codes")
    by_label = found.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
    by_label = by_label.select(F.col("label").alias("_label"), F.expr("try_cast(total AS BIGINT)").alias("label_error"))
    joined = join_small(found, by_label, F.col("label").eqNullSafe(F.col("_label")))
    digest = hashlib.sha256(line.encode()).hexdigest()
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
