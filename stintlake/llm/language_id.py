"""Language identification by multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased and every run of other characters becomes one space, so symbols, digits and layout count for
nothing. All n-grams of 1 to ``MAX_ORDER`` characters are hashed to ``2 ** BUCKET_BITS`` buckets. Training counts buckets
by language on Spark; the smoothed log-probabilities form a matrix of buckets by languages, which is broadcast (its size
is fixed by the number of buckets and ``BLOCK_LANGUAGES``). A text is a sparse row of bucket indices, scored in numpy by
summing matrix rows; long texts in pieces, so that memory does not grow with them. More languages than a matrix has columns
are scored in blocks of columns, one after the other; a posterior is over all of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.functions.joins import join_small
from stintlake.llm.common import free_name, held_out, small_batches
from stintlake.session import stage

BUCKET_BITS = 15
MAX_ORDER = 3
BLOCK_LANGUAGES = 64
UNKNOWN = "und"
#: Documents that training looks at, about: of each language an equal part, or all it has, drawn by a hash of their id.
TRAIN_DOCUMENTS = 20_000
_PIECE = 1 << 17
_LETTER = re.compile(r"[^\W\d_]")
_ALPHA: np.ndarray | None = None


def _letters() -> np.ndarray:
    """Whether a code point is a letter, for all of them; made once in a process."""
    global _ALPHA
    if _ALPHA is None:
        _ALPHA = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _ALPHA


def gram_buckets(text: str) -> Iterator[np.ndarray]:
    """The bucket of every n-gram of a text, in pieces of bounded size."""
    alpha, last = _letters(), np.array([32], np.uint32)
    for at in range(0, len(text), _PIECE):
        raw = text[at : at + _PIECE].lower().encode("utf-32-le", "surrogatepass")
        points = np.frombuffer(raw, "<u4")
        is_letter = alpha[points]
        points = np.where(is_letter, points, np.uint32(32))
        if at + _PIECE >= len(text):
            points, is_letter = np.append(points, np.uint32(32)), np.append(is_letter, False)
        before = np.concatenate(([last[-1] != 32], is_letter[:-1]))
        points = np.concatenate((last, points[is_letter | before]))
        for order in range(1, MAX_ORDER + 1):
            n = len(points) - order + 1
            skip = max(0, len(last) - order + 1)  # n-grams within what was carried over were counted before
            if n <= skip:
                continue
            mixed = np.full(n - skip, order * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
            for k in range(order):
                mixed = (mixed ^ points[skip + k : n + k]) * np.uint32(0x85EBCA6B)
                mixed ^= mixed >> np.uint32(15)
            yield mixed >> np.uint32(32 - BUCKET_BITS)
        last = points[-(MAX_ORDER - 1) :]


@dataclass(frozen=True)
class Model:
    languages: list[str]
    prior: np.ndarray  # by language
    weights: np.ndarray  # log-probability by bucket and language

    def totals(self, text: str | None) -> np.ndarray | None:
        """Log-probability of a text with each language; null for one without a letter."""
        if not self.languages or not text or not _LETTER.search(text):
            return None
        total = self.prior.copy()
        for buckets in gram_buckets(text):
            total += self.weights[buckets].sum(axis=0)
        return total

    def score(self, text: str | None) -> tuple[str, float]:
        """Most likely language and its posterior; ties go to the first by name."""
        total = self.totals(text)
        if total is None:
            return UNKNOWN, 0.0
        best = int(total.argmax())
        return self.languages[best], float(1 / np.exp(total - total[best]).sum())


def train(
    docs: DataFrame,
    text_col: str = "text",
    label_col: str = "lang",
    id_col: str = "doc_id",
    documents: int = TRAIN_DOCUMENTS,
    smoothing: float = 0.5,
) -> list[Model]:
    """Count n-grams by language over about ``documents`` rows with a label and a text; a model per block of languages.

    Every language has an equal part of the ``documents``; of one with fewer rows all are used. Priors are the languages'
    shares of all rows. The driver gets the languages with their numbers and, a block at a time, one row for each language
    and non-empty bucket. Without any labelled row there is no model.
    """
    small_batches(docs.sparkSession)
    rows = docs.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("string").alias("lang"), F.col(text_col).alias("text")
    )
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    known = {r["lang"]: r["n"] for r in sizes.collect()}
    languages, available = sorted(known), sum(known.values())
    if not available:
        return []
    each = max(1, documents // len(languages))
    place = F.pmod(F.xxhash64(F.lit("sample"), F.coalesce(F.col("id").cast("string"), F.lit(""))), F.lit(1 << 30))
    share = sizes.select("lang", F.least(F.lit(1.0), each / F.col("n")).alias("share"))
    drawn = stage(join_small(rows, share, ["lang"], "inner").where(place < F.col("share") * (1 << 30)).select("lang", "text"), "drawn")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                counts = seen.setdefault(lang, np.zeros(1 << BUCKET_BITS, np.int64))
                for buckets in gram_buckets(text):
                    counts += np.bincount(buckets, minlength=1 << BUCKET_BITS)
        for lang, counts in seen.items():
            full = np.flatnonzero(counts)
            yield pd.DataFrame({"lang": lang, "bucket": full.astype(np.int32), "n": counts[full]})

    models = []
    for at in range(0, len(languages), BLOCK_LANGUAGES):
        block = languages[at : at + BLOCK_LANGUAGES]
        counted = drawn.where(F.col("lang").isin(block)).mapInPandas(count, "lang string, bucket int, n long")
        sums = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
        table = np.zeros((1 << BUCKET_BITS, len(block)))
        if len(sums):
            column = {lang: i for i, lang in enumerate(block)}
            table[sums["bucket"].to_numpy(), sums["lang"].map(column).to_numpy()] = sums["n"].to_numpy()
        table += smoothing
        models.append(Model(block, np.log([known[x] / available for x in block]), np.log(table / table.sum(axis=0))))
    return models


def with_language(docs: DataFrame, text_col: str, name: str, models: list[Model]) -> DataFrame:
    """``docs`` with a struct column ``name`` of ``lang_pred, score``; between two blocks of languages the rows are staged."""
    context, out = docs.sparkSession.sparkContext, docs
    for number, model in enumerate(models):
        shared = context.broadcast(model)

        @F.pandas_udf("lang string, best double, rest double")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            block = shared.value
            for texts in batches:
                found = []
                for text in texts:
                    total = block.totals(text)
                    if total is None:
                        found.append((None, None, None))
                    else:
                        best = int(total.argmax())
                        found.append((block.languages[best], total[best], np.exp(total - total[best]).sum()))
                yield pd.DataFrame(found, columns=["lang", "best", "rest"]).astype({"best": "float64", "rest": "float64"})

        here = run(F.col(text_col))
        if not number:
            out = out.withColumn(name, here)
            continue
        out = stage(out, "languages").withColumn(f"{name}_b", here)
        a, b = F.col(name), F.col(f"{name}_b")
        top = F.greatest(a["best"], b["best"])
        rest = a["rest"] * F.exp(a["best"] - top) + b["rest"] * F.exp(b["best"] - top)
        # languages come in order, so the earlier block wins a tie
        lang = F.when(b["best"] > a["best"], b["lang"]).otherwise(a["lang"])
        out = out.withColumn(name, F.struct(lang.alias("lang"), top.alias("best"), rest.alias("rest"))).drop(f"{name}_b")
    found = F.col(f"{name}.lang") if models else F.lit(None).cast("string")
    score = F.when(found.isNotNull(), 1 / F.col(f"{name}.rest")).otherwise(0.0) if models else F.try_divide(F.lit(0.0), F.lit(1.0))  # nullable, as with models
    return out.withColumn(name, F.struct(F.coalesce(found, F.lit(UNKNOWN)).alias("lang_pred"), score.alias("score")))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", **options) -> DataFrame:
    """Per row: id, ``held_out``, ``lang_pred`` and ``score``, learnt from the labelled rows that are not held out.

    Null texts and texts without a letter, empty ones among them, are ``und`` with score 0, as are all texts when there is
    nothing to learn from. A null id counts as held out. Texts are scored whole, whatever their length; equal scores go to
    the first language by name. Repeated rows are scored each. Other columns are not looked at.
    """
    models = train(docs.where(~held_out(id_col)), text_col, label_col, id_col, **options)
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scored = with_language(rows, "text", "p", models)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "p.lang_pred", "p.score")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", least: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs`` whose language is known with a posterior of ``least`` or more, with all their columns.

    Null and empty texts and those without a letter go; repeated rows stay or go together; texts are scored whole. Columns
    may have any names. Without labelled rows no language is known and no row stays; an empty table stays empty.
    """
    models = train(docs.where(~held_out(id_col)), text_col, label_col, id_col, **options)
    small_batches(docs.sparkSession)
    name = free_name(docs, "_found")
    found = with_language(docs, text_col, name, models)
    known = (F.col(f"{name}.lang_pred") != UNKNOWN) & (F.col(f"{name}.score") >= least)
    return found.where(known).select(*docs.columns)
