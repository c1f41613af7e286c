"""Packing by concatenating all documents' tokens and cutting the stream into windows of equal length.

First pass: every partition tokenizes its documents and notes where each starts among the partition's tokens; the result
is written to the shared folder, so that both passes see one order. The token totals of the partitions, one row each, are
summed up in order, which turns a start inside a partition into a start in the whole stream. Second pass: a document is
cut where the stream position crosses a multiple of the window length. Only the last window is not full. No document's
neighbours are needed to cut it, so nothing is gathered or shuffled, however long a document is.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stintlake.llm.common import small_batches
from stintlake.session import stage

PAD_ID = 0
DOCUMENT_END = 1
#: Pre-tokenization of the byte-level BPE vocabulary, fixed by the tokenizer file's format.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the file: printable ones for themselves, the others from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteBpe:
    """The ids of a byte-level BPE tokenizer file whose ids are merge ranks.

    ``tiktoken`` runs the merges, several times as fast as the library the file is made for and with the same ids. A text
    it cannot take (its pattern engine has a limit on runs) goes through ``tokenizers``.
    """

    def __init__(self, path: str):
        import tiktoken

        self.path, self._slow = path, None
        spec = json.load(open(path, encoding="utf-8"))
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}
        self._special = list(special)
        self._fast = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> list[int]:
        try:
            if any(s in text for s in self._special):
                return self._fast.encode(text, allowed_special="all")
            return self._fast.encode_ordinary(text)
        except BaseException as problem:  # the Rust side panics with an exception outside Exception
            if isinstance(problem, (KeyboardInterrupt, SystemExit)):
                raise
            return self._library().encode(text, add_special_tokens=False).ids

    def _library(self):
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.path)
        return self._slow


@lru_cache(maxsize=4)
def tokenizer(path: str) -> ByteBpe:
    return ByteBpe(path)


def tokenized(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """First pass: ``part``, ``doc_id``, ``first`` (place in the part), ``n``, ``ids`` (little-endian 32-bit) as a table."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        encode, part, first = tokenizer(path).ids, TaskContext.get().partitionId(), 0
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = np.array([*encode(text or ""), DOCUMENT_END], "<u4")
                rows.append((part, doc_id, first, len(ids), ids.tobytes()))
                first += len(ids)
            yield pd.DataFrame(rows, columns=["part", "doc_id", "first", "n", "ids"]).astype({"doc_id": "Int64"})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return stage(rows.mapInPandas(run, "part int, doc_id long, first long, n long, ids binary"), "tokens", compression="zstd")


def positioned(tokens: DataFrame) -> DataFrame:
    """``tokens`` with ``at``, the document's start in the whole stream, from prefix sums over the parts' totals."""
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each task of the first pass
    starts = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return tokens.join(F.broadcast(starts), "part").withColumn("at", F.col("base") + F.col("first"))


def pack(docs: DataFrame, path: str, length: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents in sequences of ``length`` tokens.

    One row per piece: ``doc_id``, ``start`` (tokens of its document before it), ``length``, ``doc_tokens``,
    ``sequence_id``, ``offset`` (place in the sequence) and ``ids`` (little-endian 32-bit token ids). A null text is empty
    and gives its end token alone; texts are packed whole, whatever their length. Repeated rows are documents of their own;
    a null id stays null. Other columns, whatever their names, are not looked at; an empty table has no pieces.
    """
    rows = positioned(tokenized(docs, path, id_col, text_col))
    ids, at, n = F.col("ids"), F.col("at"), F.col("n")

    def piece(number: Column) -> Column:
        start = F.greatest(number * length, at)
        size = F.least((number + 1) * length, at + n) - start
        return F.struct(
            (start - at).alias("start"),
            size.alias("length"),
            number.alias("sequence_id"),
            (start - number * length).alias("offset"),
            F.substring(ids, (4 * (start - at) + 1).cast("int"), (4 * size).cast("int")).alias("ids"),
        )

    numbers = F.sequence(F.expr(f"at div {length}"), F.expr(f"(at + n - 1) div {length}"))
    # cut before exploding: a long document's ids are then copied once, not once for each piece
    cut = rows.select("doc_id", n.alias("doc_tokens"), F.transform(numbers, piece).alias("pieces"))
    return cut.select("doc_id", "doc_tokens", F.inline("pieces"))


def sequences(pieces: DataFrame, length: int = 2048) -> DataFrame:
    """Whole sequences from pieces: ``sequence_id``, ``ids`` padded to ``length`` unless a power of two, ``tokens``.

    At most ``length`` pieces meet in a sequence.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda done, p: F.concat(done, p["ids"]))
    whole = pieces.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("tokens"))
    full = F.bit_count("tokens") == 1
    pad = F.unhex(F.repeat(F.lit(np.array([PAD_ID], "<u4").tobytes().hex()), (length - F.col("tokens")).cast("int")))
    return whole.withColumn("ids", F.when(full, F.col("ids")).otherwise(F.concat("ids", pad)))
