"""Document quality by histogram gradient-boosted trees over statistics of the whole text.

A text becomes a row of numbers: sizes, shares of character classes, of words and lines that say something about them, and how
uneven the shares are along the text. The trees are grown in numpy on a bounded sample of labelled texts: every statistic
is cut into bins at its quantiles, a level of a tree is found from sums of gradients and curvatures by node and bin, and a
leaf moves the log odds by its Newton step. Trees are complete, so that all of them lie in three arrays (statistic and
threshold of each inner node, value of each leaf) and a batch of texts walks down all trees at once, a level a step.

Classes are sampled to a number each and weighted back to their share among all labels, so that scores are probabilities
at the rate of the labels.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlake.llm.common import fold, small_batches

#: Labelled texts drawn of either label.
PER_LABEL = 8_000
TREES, DEPTH, BINS = 120, 5, 64
RATE, LEAST_CURVATURE, RIDGE = 0.1, 2.0, 1.0
#: Characters and words of a segment, for how uneven a text is.
SEGMENT, WORD_SEGMENT = 400, 50
_MARKS = ".,;:!?\"'()-"
_SYMBOLS = "#*$%&|<>~^@{}[]\\/_=+"
_CLASSES = ["lower", "upper", "other_letter", "digit", "space", "line", "mark", "symbol", "rest"]
STATISTICS = [
    *(f"{c}_share" for c in _CLASSES),
    "characters",
    "words",
    "exclamations",
    "most_symbols",
    "symbol_segments",
    "least_letters",
    "most_upper",
    "word_length",
    "word_length_spread",
    "longest_word",
    "distinct_words",
    "commonest_word",
    "ten_commonest",
    "repeated_pairs",
    "repeated_fives",
    "longest_run",
    "least_distinct",
    "plain_words",
    "upper_words",
    "titled_words",
    "short_words",
    "sentence_ends",
    "lines",
    "line_length",
    "line_length_spread",
    "repeated_lines",
    "repeated_line_characters",
    "ended_lines",
    "letterless_lines",
]


@lru_cache(maxsize=1)
def _class_table() -> np.ndarray:
    """Class of every code point of the basic plane; later ones are taken for "rest"."""
    letters = {"Ll": 0, "Lu": 1, "Lt": 1, "Lm": 2, "Lo": 2, "Mn": 2, "Mc": 2, "Nd": 3, "Nl": 3, "No": 3, "Zs": 4, "Zl": 5, "Zp": 5}
    table = np.array([letters.get(unicodedata.category(chr(c)), 8) for c in range(0x10000)], np.uint8)
    for chars, kind in ((" \t", 4), ("\n\r\x0b\x0c", 5), (_MARKS, 6), (_SYMBOLS, 7)):
        table[[ord(c) for c in chars]] = kind
    return table


def _repeated(ids: np.ndarray, length: int) -> float:
    """Share of windows of ``length`` words that are in the text twice or more."""
    n = len(ids) - length + 1
    if n < 2:
        return 0.0
    mixed = np.zeros(n, np.uint64)
    for k in range(length):
        mixed = (mixed ^ ids[k : k + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    _, counts = np.unique(mixed, return_counts=True)
    return float(counts[counts > 1].sum() / n)


def statistics(text: str | None) -> list[float]:
    """The statistics of a text in the order of ``STATISTICS``; a null or empty text has zeros."""
    if not text:
        return [0.0] * len(STATISTICS)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = _class_table()[np.minimum(points, 0xFFFF)]
    kinds[points > 0xFFFF] = 8
    n = len(kinds)
    shares = np.bincount(kinds, minlength=9) / n
    begins = np.arange(0, max(1, n - SEGMENT // 2), SEGMENT)
    sizes = np.diff(np.append(begins, n))

    def by_segment(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask.astype(np.int64), begins) / sizes

    symbols = by_segment(kinds == 7)
    words = text.split()
    m = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    counts = Counter(words)
    commonest = [c for _, c in counts.most_common(10)]
    place = {w: i for i, w in enumerate(counts)}
    ids = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
    changes = np.flatnonzero(np.diff(ids)) if len(ids) else np.zeros(0, np.int64)
    runs = np.diff(np.concatenate(([-1], changes, [len(ids) - 1]))) if len(ids) else np.zeros(1)
    parts = [len(np.unique(ids[a : a + WORD_SEGMENT])) / WORD_SEGMENT for a in range(0, len(ids) - WORD_SEGMENT + 1, WORD_SEGMENT)]
    lines = [x for x in text.split("\n") if x.strip()]
    line_lengths = np.fromiter(map(len, lines), np.float64, len(lines)) if lines else np.zeros(1)
    line_counts = Counter(lines)
    again = [(len(x), c - 1) for x, c in line_counts.items() if c > 1]
    line_total = max(1, len(lines))
    kind_of_words = [(w.isalpha(), w.isupper() and len(w) > 1, w.istitle(), len(w) < 3, w[-1] in ".!?", c) for w, c in ((w.strip("\"'()"), c) for w, c in counts.items()) if w]
    flags = [sum(x[-1] for x in kind_of_words if x[k]) / m for k in range(5)]
    return [
        *shares.tolist(),
        np.log1p(n),
        np.log1p(len(words)),
        text.count("!") / m,
        symbols.max(),
        (symbols > 0.04).mean(),
        by_segment(kinds <= 2).min(),
        by_segment(kinds == 1).max(),
        lengths.mean(),
        lengths.std(),
        np.log1p(lengths.max()),
        len(counts) / m,
        commonest[0] / m if commonest else 0.0,
        sum(commonest) / m,
        _repeated(ids, 2),
        _repeated(ids, 5),
        np.log1p(runs.max()),
        min(parts, default=len(counts) / m),
        *flags,
        np.log1p(len(lines)),
        np.log1p(line_lengths.mean()),
        line_lengths.std() / (1 + line_lengths.mean()),
        sum(c for _, c in again) / line_total,
        sum(k * c for k, c in again) / n,
        sum(x.rstrip()[-1] in ".!?:" for x in lines) / line_total,
        sum(not any(map(str.isalpha, x)) for x in lines) / line_total,
    ]


def table_of(texts: list[str | None]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.float64).reshape(len(texts), len(STATISTICS))


@dataclass
class Forest:
    """Trees of one depth: ``feature`` and ``threshold`` by (tree, inner node), ``value`` by (tree, leaf); ``start`` log odds.

    Node i has the children 2 i + 1 (statistic up to the threshold) and 2 i + 2.
    """

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    start: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row, rounded to six digits."""
        trees, inner = self.feature.shape
        node = np.zeros((len(x), trees), np.int64)
        tree, row = np.arange(trees), np.arange(len(x))[:, None]
        for _ in range((inner + 1).bit_length() - 1):
            right = x[row, self.feature[tree, node]] > self.threshold[tree, node]
            node = 2 * node + 1 + right
        odds = self.start + self.value[tree, node - inner].sum(axis=1) if trees else np.full(len(x), self.start)
        return np.round(1 / (1 + np.exp(-odds)), 6)


def _grow(bins: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One tree, and the leaf of every row. Nodes without a good cut send all rows left."""
    inner = (1 << depth) - 1
    feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
    at = np.zeros(len(g), np.int64)
    for level in range(depth):
        first, many = (1 << level) - 1, 1 << level
        best = np.full(many, 1e-6)
        choice, where = np.zeros(many, np.int64), np.full(many, -1, np.int64)
        for f, cut in enumerate(cuts):
            if not len(cut):
                continue
            key = (at - first) * BINS + bins[f]
            gs = np.bincount(key, g, many * BINS).reshape(many, BINS).cumsum(axis=1)
            hs = np.bincount(key, h, many * BINS).reshape(many, BINS).cumsum(axis=1)
            g_all, h_all = gs[:, -1:], hs[:, -1:]
            gain = gs**2 / (hs + RIDGE) + (g_all - gs) ** 2 / (h_all - hs + RIDGE) - g_all**2 / (h_all + RIDGE)
            gain[(hs < LEAST_CURVATURE) | (h_all - hs < LEAST_CURVATURE)] = -1
            gain[:, len(cut) :] = -1
            top = gain.argmax(axis=1)
            better = gain[np.arange(many), top] > best
            best[better], choice[better], where[better] = gain[better, top[better]], f, top[better]
        for k in np.flatnonzero(where >= 0):
            feature[first + k], threshold[first + k] = choice[k], cuts[choice[k]][where[k]]
        k = at - first
        right = (where[k] >= 0) & (bins[choice[k], np.arange(len(g))] > where[k])
        at = 2 * at + 1 + right
    leaf = at - inner
    sums = np.bincount(leaf, g, 1 << depth)
    return feature, threshold, -RATE * sums / (np.bincount(leaf, h, 1 << depth) + RIDGE), leaf


def train(x: np.ndarray, label: np.ndarray, weight: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Forest:
    """A forest for ``label`` (0 or 1); without rows of both labels it has no trees and the labels' rate, or 0.5, as score."""
    nothing = np.zeros((0, (1 << depth) - 1))
    if not len(label) or label.min() == label.max():
        rate = float(label.mean()) if len(label) else 0.5
        return Forest(nothing.astype(np.int64), nothing, np.zeros((0, 1 << depth)), float(np.log((rate + 1e-3) / (1 - rate + 1e-3))))
    cuts = []
    for f in range(x.shape[1]):
        steps = np.unique(np.quantile(x[:, f], np.arange(1, BINS) / BINS, method="lower"))
        cuts.append(steps[steps < x[:, f].max()])
    bins = np.stack([np.searchsorted(cut, x[:, f], side="left") for f, cut in enumerate(cuts)])
    rate = np.average(label, weights=weight)
    start = float(np.log(rate / (1 - rate)))
    odds, grown = np.full(len(label), start), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-odds))
        feature, threshold, value, leaf = _grow(bins, cuts, weight * (p - label), weight * p * (1 - p), depth)
        odds += value[leaf]
        grown.append((feature, threshold, value))
    return Forest(*(np.array(part) for part in zip(*grown)), start)


def sample(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id_col: str, label_col: str, per_label: int, out: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Statistics, labels and weights of up to ``per_label`` texts of either label that are not held out.

    Texts are drawn by a hash of their id. An id with several labels has the lower one, one with several texts the one
    whose statistics come first. Only statistics come to the driver, a row an id.
    """
    small_batches(docs.sparkSession)
    known = labels.select(F.col(label_id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1)")
    known = known.where(fold("id", 4) != out).groupBy("id").agg(F.min("label").alias("label"))
    rates = dict(known.groupBy("label").count().collect())
    order = [F.xxhash64(F.lit("sample"), "id"), F.col("id")]
    drawn = [known.where(F.col("label") == label).orderBy(*order).limit(per_label) for label in (0, 1)]

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "label": batch["label"], "x": list(table_of(batch["text"].tolist()))})

    ids = drawn[0].unionByName(drawn[1])  # at most twice per_label rows of an id and a label
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id")
    found = texts.mapInPandas(measure, "id long, label int, x array<double>").groupBy("id", "label").agg(F.min("x").alias("x"))
    found = found.toPandas().sort_values("id")
    label = found["label"].to_numpy(np.int64)
    drawn_rates = np.bincount(label, minlength=2)
    weight = np.array([rates.get(k, 0) / max(1, drawn_rates[k]) for k in (0, 1)])[label]
    x = np.array(found["x"].tolist(), np.float64).reshape(len(found), len(STATISTICS))
    return x, label, weight / weight.mean() if len(weight) else weight


def quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    label_col: str = "quality",
    per_label: int = PER_LABEL,
    threshold: float = 0.7,
    out: int = 2,
) -> DataFrame:
    """Per row: id, ``held_out`` (crc32 of the id modulo 4 is ``out``), ``score`` (0 to 1) and ``predicted``.

    Whole texts of any length are measured; null and empty ones have zeros for statistics and the score of that. A null id
    counts as held out. Labels other than 0 and 1, and labels of unknown texts, are not used; without labels of both
    kinds every text has the same score. Repeated rows are scored each; other columns are not looked at.
    """
    spark = docs.sparkSession
    forest = spark.sparkContext.broadcast(train(*sample(docs, labels, id_col, text_col, label_id_col, label_col, per_label, out)))
    small_batches(spark)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(forest.value.scores(table_of(texts.tolist())))

    held: Column = F.coalesce(fold("doc_id", 4) == out, F.lit(True))
    rows = docs.select(F.col(id_col).alias("doc_id"), run(F.col(text_col)).alias("score"))
    return rows.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
