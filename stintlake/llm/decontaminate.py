"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are lower-cased and everything but letters and digits becomes one space. An item of ``m`` characters may
be met with ``k = floor(rate * m)`` edits. Cut it into ``k + 1`` pieces: in any passage within ``k`` edits of the item at
least one piece stands unchanged. An Aho-Corasick automaton over all pieces finds the exact hits in one pass over the
text, and Myers' bit-parallel algorithm gives the least edit distance of the item to any passage of the text around a hit.
The same pigeonhole argument on halves spares most of that work: a hit is first measured on the runs of 2, 4, ... pieces
around it, each with its share of the budget. What stands fixes where the item would begin; hits that agree on that to
within ``k`` are one candidate for the whole item.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlake.functions.joins import join_small
from stintlake.functions.ordered import OrderedGroups
from stintlake.llm.common import free_name, small_batches
from stintlake.session import stage

#: Edits allowed for each character of an item.
EDIT_RATE = 0.1
#: Characters of items that share an automaton; a larger benchmark is matched block after block.
BLOCK_CHARS = 16 << 20
#: A shorter item is no evidence inside a text; it is only met by a text that is the item.
LEAST_CHARS = 20
HIT = "struct<item_id: long, start: long, stop: long, distance: int>"
_APART = re.compile(r"[\W_]+")


def normalised(text: str | None) -> str:
    return _APART.sub(" ", (text or "").lower()).strip()


def least_distance(item: str, text: str) -> tuple[int, int]:
    """Least edit distance of ``item`` to any passage of ``text``, and where the first such passage ends (Myers 1999).

    Bit ``i`` of the column vectors stands for the step between rows ``i`` and ``i + 1`` of the table; Python's integers
    give them as many bits as the item has characters.
    """
    m = len(item)
    places: dict[str, int] = {}
    for i, c in enumerate(item):
        places[c] = places.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, distance = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        same = places.get(c, 0)
        diagonal = ((((same & up) + up) ^ up) | same) | down
        rise = down | ~(diagonal | up) & full
        fall = up & diagonal
        if rise & top:
            distance += 1
        elif fall & top:
            distance -= 1
        rise, fall = rise << 1 & full, fall << 1 & full
        vertical = same | down
        up = fall | ~(vertical | rise) & full
        down = rise & vertical
        if distance < best:
            best, end = distance, j
    return best, end


class Matcher:
    """All passages of a text that are close to some item."""

    def __init__(self, items: list[tuple[int, str]], rate: float = EDIT_RATE):
        self.items: list[tuple[int, str, list[int]]] = []  # id, text, bounds of its pieces
        self.short: dict[str, list[int]] = {}
        places: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            if len(text) < LEAST_CHARS:
                self.short.setdefault(text, []).append(item_id)
                continue
            pieces = int(rate * len(text)) + 1
            bounds = [p * len(text) // pieces for p in range(pieces + 1)]
            for p in range(pieces):
                places.setdefault(text[bounds[p] : bounds[p + 1]], []).append((len(self.items), p))
            self.items.append((item_id, text, bounds))
        self.automaton = ahocorasick.Automaton()
        for piece, of in places.items():
            self.automaton.add_word(piece, (len(piece), of))
        if places:
            self.automaton.make_automaton()
        # passages that many documents share are measured once
        self.measure = lru_cache(maxsize=1 << 14)(least_distance)

    def _stands(self, text: str, number: int, piece: int, begin: int) -> bool:
        """Whether a hit survives on ever longer parts of its item, short of the whole.

        The budget of a run of pieces is one less than their number. A run within its budget has a half within its own, so
        a true passage has a hit that passes at every step, and most others end after a few characters.
        """
        _, item, bounds = self.items[number]
        low, high, runs = 0, len(bounds) - 1, []
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (low, middle) if piece < middle else (middle, high)
            runs.append((low, high))
        for low, high in reversed(runs[:-1]):
            start, stop, budget = bounds[low], bounds[high], high - low - 1
            around = text[max(0, begin + start - budget) : max(0, begin + stop + budget)]
            if self.measure(item[start:stop], around)[0] > budget:
                return False
        return True

    def hits(self, raw: str | None) -> list[tuple[int, int, int, int]]:
        """``(item_id, start, stop, distance)``, one for each item met, with its closest and then first passage.

        Places are those of the normalised text; ``start`` is the earliest at which the passage can begin.
        """
        text = normalised(raw)
        if text in self.short:
            return [(i, 0, len(text), 0) for i in sorted(set(self.short[text])) if text]
        if not text or not len(self.automaton):
            return []
        begins: dict[int, list[int]] = {}
        for end, (size, of) in self.automaton.iter(text):
            for number, piece in of:
                begin = end + 1 - size - self.items[number][2][piece]
                if self._stands(text, number, piece, begin):
                    begins.setdefault(number, []).append(begin)
        found: dict[int, tuple[int, int, int]] = {}
        for number, at in begins.items():
            item_id, item, bounds = self.items[number]
            k, best = len(bounds) - 2, None
            for low, high in _clusters(sorted(at), k):
                left, right = max(0, low - k), high + len(item) + k
                distance, end = self.measure(item, text[left:right])
                if distance <= k and (best is None or distance < best[0]):
                    best = (distance, left, left + end)
                if best and not best[0]:
                    break
            if best and (item_id not in found or best < found[item_id]):
                found[item_id] = best
        return [(i, start, stop, d) for i, (d, start, stop) in sorted(found.items())]


def _clusters(places: list[int], gap: int) -> Iterator[tuple[int, int]]:
    """First and last of each run of sorted places whose steps are at most ``gap``."""
    low = high = places[0]
    for p in places[1:]:
        if p - high > gap:
            yield low, high
            low = p
        high = p
    yield low, high


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's items in blocks of about ``block_chars`` characters; one block at a time comes to the driver.

    Tasks normalise the items; those that share an id are in one block.
    """

    def clean(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"i": batch["i"], "t": [normalised(t).encode("utf-8", "replace").decode() for t in batch["t"]]})

    rows = items.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).where("i is not null and t is not null")
    ready = stage(rows.mapInPandas(clean, "i long, t string").where("t <> ''").distinct(), "items")
    sizes = ready.groupBy("i").agg(F.sum(F.length("t")).alias("n"))
    numbered = OrderedGroups(sizes, [], ["i"]).running(sums={"upto": F.col("n")}).result()
    numbered = numbered.select("i", F.floor((F.col("upto") - F.col("n")) / block_chars).alias("block"))
    ready = stage(join_small(ready, numbered, ["i"], "inner"), "items")
    for number in [r[0] for r in ready.select("block").distinct().orderBy("block").collect()]:
        yield [(r["i"], r["t"]) for r in ready.where(F.col("block") == number).orderBy("i", "t").collect()]


def _block_hits(text: Column, shared: Broadcast, rate: float) -> Column:
    @F.pandas_udf(f"array<{HIT}>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(shared.value, rate)
        for texts in batches:
            yield pd.Series([[dict(zip(("item_id", "start", "stop", "distance"), h)) for h in matcher.hits(t)] for t in texts])

    return run(text)


def with_hits(docs: DataFrame, text_col: str, name: str, items: DataFrame, id_col: str, text_of_item: str, rate: float, block_chars: int) -> DataFrame:
    """``docs`` with an array column ``name`` of the ``HIT`` of every item met.

    A benchmark of one block, as nearly all are, is matched as the rows pass by. With more, the rows are matched with one
    block after the other and staged in between, so that neither a worker nor the driver ever has more than a block.
    """
    context, out, held = docs.sparkSession.sparkContext, docs.withColumn(name, F.array().cast(f"array<{HIT}>")), None
    for block in item_blocks(items, id_col, text_of_item, block_chars):
        if held is not None:
            out = stage(out, "hits")
            held.unpersist()
        held = context.broadcast(block)
        found = _block_hits(F.col(text_col), held, rate)
        out = out.withColumn(name, F.concat(F.col(name), found))
    return out


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    rate: float = EDIT_RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Per row of ``docs``: id, ``contaminated``, ``item_ids`` (in order) and ``hits`` with place and distance.

    Null and empty texts are clean; null and empty items, and items without an id, match nothing. Items of fewer
    than ``LEAST_CHARS`` characters are met only by a text that is the item. Items that share an id count once. Whole texts
    are matched, whatever their length; repeated rows have a row each. Other columns are not looked at.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = with_hits(rows, "text", "hits", items, item_id_col, item_text_col, rate, block_chars)
    ids = F.array_sort(F.array_distinct(F.col("hits.item_id")))
    return found.select("doc_id", (F.size("hits") > 0).alias("contaminated"), ids.alias("item_ids"), "hits")


def keep_clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", rate: float = EDIT_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that meet no item, with all their columns, whatever their names.

    Null and empty texts stay; whole texts are matched, whatever their length; repeated rows stay or go together; an empty
    table or benchmark takes nothing away.
    """
    small_batches(docs.sparkSession)
    name = free_name(docs, "_hits")
    found = with_hits(docs, text_col, name, items, item_id_col, item_text_col, rate, block_chars)
    return found.where(F.size(name) == 0).select(*docs.columns)
