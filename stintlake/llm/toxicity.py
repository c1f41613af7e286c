"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A word's input is its own vector, from a hashed table, beside the mean vector of its hashed character trigrams, so that
spellings never seen still mean something. Two gated recurrent units read a window of words in either direction,
attention weighs the states, and a logistic unit gives the window's probability. All windows of a text, each overlapping
the next by half, are scored; the text has the score of its worst window.

Training sees all windows of a bounded number of labelled texts. Only texts are labelled, so it learns from several
instances: first every window has its text's label; then, in each later epoch, of a toxic text only the window that now
scores highest. Few texts say one word over and over, so the network also gets windows that repeat a word of a clean text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlake.llm.common import held_out, small_batches

WINDOW, STRIDE = 24, 12
WORD_BITS, TRIGRAM_BITS = 17, 13
WIDTH, HIDDEN = 8, 8
#: Training sample: texts of either label, all of their windows, and for each clean one some that repeat one of its words.
TOXIC_TEXTS, CLEAN_TEXTS, REPEATED = 800, 1600, 8
EPOCHS, BATCH, RATE, SEED = 4, 512, 0.01, 7
#: Written words whose gate inputs a worker keeps; when full it starts anew.
REMEMBERED = 250_000
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")


def words_of(text: str | None) -> list[str]:
    """Lower-case words without marks around them; what is marks alone is no word."""
    raw = (text or "").lower().split()
    return [w for w in (x if x.isalnum() else _EDGE.sub("", x) for x in raw) if w]


def windows_of(ids: np.ndarray) -> np.ndarray:
    """All windows over a text's word ids, padded with 0; a text without words is one empty window."""
    count = max(1, -(-(len(ids) - WINDOW) // STRIDE) + 1)
    padded = np.zeros((count - 1) * STRIDE + WINDOW, np.int64)
    padded[: len(ids)] = ids
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STRIDE]


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of distinct words: bucket of each, buckets of all their trigrams, and where each word's trigrams begin."""
    own = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint32, len(words)) >> np.uint32(32 - WORD_BITS)
    line = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), "<u4")
    sizes = np.fromiter((len(w) for w in words), np.int64, len(words))  # a word of n characters has n trigrams with its ends
    begins = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
    at = np.repeat(np.arange(len(words)) * 2 + begins, sizes) + (np.arange(sizes.sum()) - np.repeat(begins, sizes))
    mixed = line[at] * np.uint32(0x9E3779B1) ^ line[at + 1] * np.uint32(0x85EBCA6B) ^ line[at + 2] * np.uint32(0xC2B2AE35)
    mixed = (mixed ^ mixed >> np.uint32(15)) * np.uint32(0x27D4EB2F)
    return own.astype(np.int64), (mixed >> np.uint32(32 - TRIGRAM_BITS)).astype(np.int64), begins


def new_parameters(seed: int = SEED) -> dict[str, np.ndarray]:
    random = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (random.standard_normal(shape) * scale).astype(np.float32)

    p = {"word": np.zeros((1 << WORD_BITS, WIDTH), np.float32), "trigram": normal(1 << TRIGRAM_BITS, WIDTH, scale=0.3)}
    for side in ("fore", "back"):
        p[f"{side}_in"] = normal(2 * WIDTH, 3 * HIDDEN, scale=(2 * WIDTH) ** -0.5)
        p[f"{side}_state"] = normal(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5)
        p[f"{side}_bias"] = np.zeros(3 * HIDDEN, np.float32)
    p["attention"] = normal(2 * HIDDEN, scale=0.1)
    p["out"] = normal(2 * HIDDEN, scale=0.1)
    p["out_bias"] = np.full(1, -1.0, np.float32)
    return p


def word_vectors(p: dict, own: np.ndarray, trigrams: np.ndarray, begins: np.ndarray, drop: np.ndarray | None = None) -> np.ndarray:
    """Inputs of distinct words; row 0 is the padding."""
    x = np.zeros((len(own) + 1, 2 * WIDTH), np.float32)
    if len(own):
        x[1:, :WIDTH] = p["word"][own] if drop is None else p["word"][own] * drop
        sizes = np.diff(np.append(begins, len(trigrams)))
        x[1:, WIDTH:] = np.add.reduceat(p["trigram"][trigrams], begins, axis=0) / sizes[:, None]
    return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(np.minimum(x, 60, out=x), out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _recur(p: dict, side: str, gates: np.ndarray, ids: np.ndarray, mask: np.ndarray, keep: list | None) -> np.ndarray:
    """States of one direction, (words, windows, HIDDEN); ``keep`` takes what the way back needs."""
    n, length = ids.shape
    h, weights = np.zeros((n, HIDDEN), np.float32), p[f"{side}_state"]
    states = np.empty((length, n, HIDDEN), np.float32)
    for t in range(length) if side == "fore" else range(length - 1, -1, -1):
        given, state = gates[ids[:, t]], h @ weights
        both = _sigmoid(given[:, : 2 * HIDDEN] + state[:, : 2 * HIDDEN])
        z, r = both[:, :HIDDEN], both[:, HIDDEN:]
        new = np.tanh(given[:, 2 * HIDDEN :] + r * state[:, 2 * HIDDEN :])
        here = mask[:, t : t + 1]
        if keep is not None:
            keep.append((t, h, z, r, new, state[:, 2 * HIDDEN :]))
        h = h + here * (1 - z) * (new - h)
        states[t] = h
    return states


def _gates(p: dict, side: str, x: np.ndarray) -> np.ndarray:
    return x @ p[f"{side}_in"] + p[f"{side}_bias"]


def _pool(p: dict, states: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Attention weights, pooled states and probabilities; a window without words pools nothing."""
    weigh = states @ p["attention"]
    weigh = np.exp(np.clip(weigh - weigh.max(axis=0), -60, 0)) * mask.T
    weigh /= np.maximum(weigh.sum(axis=0), 1e-9)
    pooled = np.einsum("tn,tnk->nk", weigh, states)
    return weigh, pooled, _sigmoid(pooled @ p["out"] + p["out_bias"])


def window_scores(p: dict, gates: tuple[np.ndarray, np.ndarray], ids: np.ndarray) -> np.ndarray:
    mask = (ids > 0).astype(np.float32)
    states = [_recur(p, side, g, ids, mask, None) for side, g in zip(("fore", "back"), gates)]
    return _pool(p, np.concatenate(states, axis=2), mask)[2]


def gradients(p: dict, words: tuple, ids: np.ndarray, target: np.ndarray, drop: np.ndarray) -> tuple[dict, float]:
    """Gradient of the mean cross-entropy over windows, and its value. Table rows come as (rows, values)."""
    own, trigrams, begins = words
    x, mask = word_vectors(p, own, trigrams, begins, drop), (ids > 0).astype(np.float32)
    kept: dict[str, list] = {"fore": [], "back": []}
    states = np.concatenate([_recur(p, s, _gates(p, s, x), ids, mask, kept[s]) for s in kept], axis=2)
    weigh, pooled, score = _pool(p, states, mask)
    n, length = ids.shape
    loss = -np.log(np.maximum(np.where(target > 0, score, 1 - score), 1e-7)).mean()
    d = (score - target).astype(np.float32) / n
    g = {"out": pooled.T @ d, "out_bias": d.sum(keepdims=True)}
    d_pooled = d[:, None] * p["out"]
    along = np.einsum("tnk,nk->tn", states, d_pooled)
    d_weigh = weigh * (along - (weigh * along).sum(axis=0))
    g["attention"] = np.einsum("tn,tnk->k", d_weigh, states)
    d_states = weigh[:, :, None] * d_pooled + d_weigh[:, :, None] * p["attention"]
    d_x, order = np.zeros_like(x), np.argsort(ids.T.ravel(), kind="stable")
    rows, first = np.unique(ids.T.ravel()[order], return_index=True)
    for k, side in enumerate(kept):
        weights, d_weights = p[f"{side}_state"], np.zeros_like(p[f"{side}_state"])
        d_gates = np.empty((length, n, 3 * HIDDEN), np.float32)
        d_h = np.zeros((n, HIDDEN), np.float32)
        for t, h, z, r, new, state_new in reversed(kept[side]):
            d_h = d_h + d_states[t, :, k * HIDDEN : (k + 1) * HIDDEN]
            here = mask[:, t : t + 1]
            d_new = d_h * here * (1 - z) * (1 - new * new)
            d_z = -d_h * here * (new - h) * z * (1 - z)
            d_r = d_new * state_new * r * (1 - r)
            d_gates[t] = np.concatenate((d_z, d_r, d_new), axis=1)
            d_state = np.concatenate((d_z, d_r, d_new * r), axis=1)
            d_weights += h.T @ d_state
            d_h = d_h * (1 - here * (1 - z)) + d_state @ weights.T
        by_word = np.zeros((len(x), 3 * HIDDEN), np.float32)
        by_word[rows] = np.add.reduceat(d_gates.reshape(-1, 3 * HIDDEN)[order], first, axis=0)
        by_word[0] = 0
        g |= {f"{side}_state": d_weights, f"{side}_in": x.T @ by_word, f"{side}_bias": by_word.sum(axis=0)}
        d_x += by_word @ p[f"{side}_in"].T
    sizes = np.diff(np.append(begins, len(trigrams)))
    g["word"] = (own, d_x[1:, :WIDTH] * drop)
    g["trigram"] = (trigrams, np.repeat(d_x[1:, WIDTH:] / sizes[:, None], sizes, axis=0))
    return g, float(loss)


class Adam:
    def __init__(self, p: dict, rate: float):
        self.p, self.rate, self.step = p, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in p.items()}
        self.square = {k: np.zeros_like(v) for k, v in p.items()}

    def update(self, g: dict) -> None:
        """Tables move only in the rows that a batch touched."""
        self.step += 1
        fix = np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        for name, value in g.items():
            at: slice | np.ndarray = slice(None)
            if isinstance(value, tuple):
                at, back = np.unique(value[0], return_inverse=True)
                sums = np.zeros((len(at), value[1].shape[1]), np.float32)
                np.add.at(sums, back, value[1])
                value = sums
            mean = self.mean[name][at] * 0.9 + 0.1 * value
            square = self.square[name][at] * 0.999 + 0.001 * value * value
            self.mean[name][at], self.square[name][at] = mean, square
            self.p[name][at] -= self.rate * fix * mean / (np.sqrt(square) + 1e-7)


class Scorer:
    """Scores texts; gate inputs of words already met are kept, by the words as they were written."""

    def __init__(self, p: dict):
        self.p = p
        self._forget()

    def _forget(self) -> None:
        pad = np.zeros((1, 2 * WIDTH), np.float32)
        self.place: dict[str, int] = {}
        self.rows: dict[str, int] = {}
        self.size = 1
        self.gates = [np.repeat(_gates(self.p, side, pad), 1024, axis=0) for side in ("fore", "back")]

    def _learn(self, raw: set[str]) -> None:
        """Give words a row each; marks alone have row 0, which is no word."""
        fresh = sorted(raw)
        bare = [w if w.isalnum() else _EDGE.sub("", w) for w in fresh]
        new = list(dict.fromkeys(w for w in bare if w and w not in self.rows))
        if new:
            x, end = word_vectors(self.p, *features(new))[1:], self.size + len(new)
            for i, side in enumerate(("fore", "back")):
                if end > len(self.gates[i]):
                    more = np.zeros((max(end, len(self.gates[i])), 3 * HIDDEN), np.float32)
                    self.gates[i] = np.concatenate((self.gates[i], more))
                self.gates[i][self.size : end] = _gates(self.p, side, x)
            self.rows.update(zip(new, range(self.size, end)))
            self.size = end
        self.place.update((w, self.rows.get(b, 0)) for w, b in zip(fresh, bare))

    def texts(self, texts: list[str | None]) -> np.ndarray:
        """Score of each text: that of its highest window."""
        if len(self.place) > REMEMBERED:
            self._forget()
        raw, place = [(t or "").lower().split() for t in texts], self.place
        self._learn({w for words in raw for w in words if w not in place})
        result, held, owners, many = np.zeros(len(texts)), [], [], 0

        def settle() -> None:
            if held:
                scores = window_scores(self.p, tuple(self.gates), np.concatenate(held))
                np.maximum.at(result, np.concatenate(owners), scores)
                held.clear()
                owners.clear()

        for i, words in enumerate(raw):
            ids = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
            found = windows_of(ids[ids > 0])
            for at in range(0, len(found), 4096):
                held.append(found[at : at + 4096])
                owners.append(np.full(len(held[-1]), i))
                many += len(held[-1])
                if many >= 4096:
                    settle()
                    many = 0
        settle()
        return np.round(result, 6)


def sample_windows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id_col: str, label_col: str, toxic: int, clean: int) -> pd.DataFrame:
    """``id, label, windows`` (each a line of words) of up to ``toxic`` and ``clean`` labelled texts that are not held out.

    Texts are drawn by a hash of their id; an id with several labels has the highest, one with several texts that whose
    windows come first. All windows of a drawn text come to the driver, one row an id.
    """
    spark = docs.sparkSession
    small_batches(spark)
    known = labels.select(F.col(label_id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1)")
    known = known.where(~held_out("id")).groupBy("id").agg(F.max("label").alias("label"))
    order = [F.xxhash64(F.lit("sample"), "id"), F.col("id")]
    drawn = [known.where(F.col("label") == label).orderBy(*order).limit(n) for label, n in ((1, toxic), (0, clean))]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lines = []
            for text in batch["text"]:
                words = words_of(text)
                begins = range(0, max(1, len(words) - WINDOW + STRIDE), STRIDE)
                lines.append("\n".join(" ".join(words[b : b + WINDOW]) for b in begins))
            yield pd.DataFrame({"id": batch["id"], "label": batch["label"], "windows": lines})

    ids = drawn[0].unionByName(drawn[1])  # at most toxic + clean rows
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id")
    found = texts.mapInPandas(cut, "id long, label int, windows string").groupBy("id", "label").agg(F.min("windows").alias("windows"))
    return found.toPandas().sort_values("id").reset_index(drop=True)


def _spans(owner: list[int]) -> Iterator[tuple[int, int, int]]:
    """``(owner, first, last + 1)`` of each run of equal owners."""
    ends = [k + 1 for k in range(len(owner)) if k + 1 == len(owner) or owner[k] != owner[k + 1]]
    for first, last in zip([0, *ends], ends):
        yield owner[first], first, last


def train(sample: pd.DataFrame, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """Parameters learnt from ``sample_windows``; without texts of both labels those of an untrained network."""
    p = new_parameters()
    if sample.empty or sample["label"].nunique() < 2:
        return p
    place: dict[str, int] = {}
    rows, owner = [], []
    for i, lines in enumerate(sample["windows"]):
        for line in lines.split("\n"):
            ids = np.zeros(WINDOW, np.int64)
            words = line.split()
            ids[: len(words)] = [place.setdefault(w, len(place) + 1) for w in words]
            rows.append(ids)
            owner.append(i)
    random, adam = np.random.default_rng(SEED), Adam(p, RATE)
    said = {i: np.concatenate([r[r > 0] for r in rows[a:b]]) for i, a, b in _spans(owner) if sample["label"].iat[i] == 0}
    clean = np.flatnonzero(sample["label"].to_numpy() == 0)
    for i in clean:
        for word in random.choice(said[i], min(REPEATED, len(said[i])), replace=False):
            rows.append(np.full(WINDOW, word))
            owner.append(i)
    ids, owner = np.array(rows), np.array(owner)
    label = sample["label"].to_numpy()[owner].astype(np.float32)
    own, trigrams, begins = features(list(place))
    ends = np.append(begins, len(trigrams))
    for epoch in range(epochs):
        use = np.arange(len(ids))
        if epoch:
            x = word_vectors(p, own, trigrams, begins)
            gates = tuple(_gates(p, s, x) for s in ("fore", "back"))
            scores = np.concatenate([window_scores(p, gates, ids[a : a + 4096]) for a in range(0, len(ids), 4096)])
            by_text = np.lexsort((-scores, owner))
            best = by_text[np.concatenate(([True], np.diff(owner[by_text]) > 0))]
            use = np.union1d(np.flatnonzero(label == 0), best)
        random.shuffle(use)
        adam.rate = RATE * (1 - epoch / epochs)
        for a in range(0, len(use), BATCH):
            batch = use[a : a + BATCH]
            present, local = np.unique(ids[batch], return_inverse=True)
            if present[0] != 0:
                present, local = np.append(0, present), local + 1
            words = present[1:] - 1
            spans = [trigrams[ends[w] : ends[w + 1]] for w in words]
            sizes = ends[words + 1] - ends[words]
            local_begins = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64) if len(words) else np.zeros(0, np.int64)
            kept = (random.random((len(words), 1)) > 0.3).astype(np.float32)  # so that trigrams learn too
            joined = np.concatenate(spans) if spans else np.zeros(0, np.int64)
            g, _ = gradients(p, (own[words], joined, local_begins), local.reshape(-1, WINDOW), label[batch], kept)
            adam.update(g)
    return p


def scored(p: dict, text: Column, spark: SparkSession) -> Column:
    shared = spark.sparkContext.broadcast(p)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for texts in batches:
            yield pd.Series(scorer.texts(texts.tolist()))

    return run(text)


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    label_col: str = "toxic",
    toxic: int = TOXIC_TEXTS,
    clean: int = CLEAN_TEXTS,
    threshold: float = 0.5,
) -> DataFrame:
    """Per row: id, ``held_out``, ``score`` (0 to 1) and ``predicted``.

    All words of a text are scored, whatever its length. Null and empty texts, and texts without a word, are one empty window
    and have the network's score of that. A null id counts as held out. Labels other than 0 and 1, and labels of unknown texts, are not used; without labels of both kinds
    the network is untrained. Repeated rows are scored each; other columns are not looked at.
    """
    p = train(sample_windows(docs, labels, id_col, text_col, label_id_col, label_col, toxic, clean))
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), scored(p, F.col(text_col), docs.sparkSession).alias("score"))
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
