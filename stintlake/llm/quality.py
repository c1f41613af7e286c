"""Quality rules by distribution divergence, in DataFrame functions only.

A document is described by two histograms: code points by character class, and words by common word of some language
(all other words in one bin). References are made in two fits. The first is the mean class histogram of the documents of
sufficient length that are no further from the mean of all than the average; documents near it are accepted, however they
are labelled, so that junk makes no reference by having a label of its own, nor by being up to a third of all. The second are the mean histograms of the accepted documents, by language and over all of them.

A document's distances are the Jensen-Shannon distances (square roots of the divergences to base 2, 0 to 1) to the nearest
reference. The two divergences are added, and the root of the sum must not exceed a limit that allows for the sampling error
of short texts. Languages with a good share of the accepted documents vouch for documents of any label, so that a wrong or
missing label costs little; rarer ones vouch for their own. A document whose label has no reference is judged by its
character classes alone, against the mean of all. Texts too short for a histogram to mean anything are not judged by
distance. Base rules come first: too few words, or too many words in 8-word windows that occur again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlake.functions.joins import join_small
from stintlake.llm.common import SPACE_CLASS, WORD_CLASS, free_name
from stintlake.session import stage

RESULTS = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept class_distance word_distance".split()

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
#: A histogram of fewer words or characters is not compared.
GUARD_WORDS = 60
GUARD_CHARS = 240
#: Largest distance to the nearest reference: a constant, and what the histogram of a sample of n words strays by, over sqrt(n).
MOST_DISTANCE = 0.24
SAMPLING_DISTANCE = 1.1
#: Accepted documents that a language needs for a reference, and their share of all for one that holds for other labels
#: too. There are at most as many of those as the share goes into the whole.
LEAST_LANGUAGE_DOCS = 10
VOUCHING_SHARE = 0.005

# Frequent function words of the four languages.
COMMON_WORDS = {
    "de": "das der die ein eine den dem des du er es für im in ist mit nicht sich und von zu",
    "en": "a and are as at be by for from has he in is it not of on or that the this to was with",
    "es": "al con de del el en es la las lo los no para por que se su un una y",
    "fr": "à au avec ce dans de des du elle en est et il la le les ne par pas pour que qui sur un une",
}
COMMON = sorted({w for words in COMMON_WORDS.values() for w in words.split()})

# The symbols of the base rules.
SYMBOLS = "[#*$%&|<>]"
# Character classes that are counted by pattern; white space, symbols and the rest (small letters, mostly) join them.
CLASSES = {"upper": r"\p{Lu}", "digit": r"\p{Nd}", "mark": r"[.,;:!?'()\"-]"}
N_CLASSES = len(CLASSES) + 3


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` in order."""
    return F.array_remove(F.split(text, SPACE_CLASS, -1), "")


def repeated_words(words: Column) -> Column:
    """Words in windows of ``WINDOW`` words that occur at two or more places of the text, the first included.

    Windows are told apart by a 64-bit hash, built from those of windows half as long. Texts without a repeat, nearly all,
    only pay for the set of hashes. Otherwise the windows are sorted by hash, those with an equal neighbour sorted by
    place, and each covers the words up to the next one's start.
    """

    def doubled(hashes: Column, step: int) -> Column:
        return let(hashes, lambda h: F.zip_with(h, F.slice(h, step + 1, F.greatest(F.size(h) - step, F.lit(0))), lambda a, b: F.xxhash64(a, b)))

    hashes, step = F.transform(words, lambda w: F.xxhash64(w)), 1
    while step < WINDOW:
        hashes, step = doubled(hashes, step), 2 * step
    hashes = F.slice(hashes, 1, F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))

    def twins(o: Column) -> Column:
        return F.filter(o, lambda x, k: _same(F.get(o, k + 1), x) | _same(F.get(o, k - 1), x))

    def union_length(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda x, y: x + y)

    def covered(marks: Column) -> Column:
        ordered = F.array_sort(F.transform(marks, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        places = let(ordered, lambda o: F.array_sort(F.transform(twins(o), lambda x: x["i"])))
        return let(places, union_length)

    found = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
    return F.when(F.size(words) > WINDOW, found).otherwise(0).cast("long")


def _same(other: Column, x: Column) -> Column:
    return F.coalesce(other["h"] == x["h"], F.lit(False))


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.rlike(x, F.lit(WORD_CLASS)))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def class_histogram(text: Column, n_chars: Column, word_chars: Column, n_symbols: Column) -> Column:
    """Share of each character class, the rest last."""
    counts = [F.regexp_count(text, F.lit(pattern)) for pattern in CLASSES.values()]
    counts += [n_chars - word_chars, n_symbols]
    named = F.array(*[c.cast("double") for c in counts])
    total = F.greatest(n_chars, F.lit(1)).cast("double")

    def shares(x: Column) -> Column:
        rest = F.greatest(n_chars - F.aggregate(x, F.lit(0.0), lambda a, b: a + b), F.lit(0.0))
        return F.transform(F.concat(x, F.array(rest)), lambda n: n / total)

    return let(named, shares)


def word_histogram(words: Column) -> Column:
    """Share of each common word, all others last; a word's first letter may be a capital."""
    written = COMMON + [w.capitalize() for w in COMMON]
    hits = F.transform(F.filter(words, lambda w: w.isin(written)), lambda w: F.lower(w))
    total = F.greatest(F.size(words), F.lit(1)).cast("double")

    def shares(h: Column) -> Column:
        counts = F.array(*[F.size(h) - F.size(F.array_remove(h, w)) for w in COMMON], F.size(words) - F.size(h))
        return F.transform(counts, lambda n: n / total)

    return let(hits, shares)


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of equal length."""

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    terms = F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda x, y: x + y) / 2, F.lit(0.0)))


def _measured(docs: DataFrame, text_col: str, mark: str) -> DataFrame:
    """``docs`` with the base counts and both histograms, in columns whose names begin with ``mark``."""
    text, words = F.col(f"{mark}text"), F.col(f"{mark}words")
    rows = docs.withColumn(f"{mark}text", F.coalesce(F.col(text_col), F.lit("")))
    rows = rows.withColumn(f"{mark}words", words_of(text))
    rows = rows.withColumns(
        {
            f"{mark}n_words": F.size(words).cast("long"),
            f"{mark}n_chars": F.char_length(text).cast("long"),
            f"{mark}word_chars": F.char_length(F.array_join(words, "")).cast("long"),
            f"{mark}n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        }
    )
    classes = class_histogram(text, *[F.col(f"{mark}{n}") for n in ("n_chars", "word_chars", "n_symbols")])
    return rows.withColumns(
        {
            f"{mark}n_dup_lines": duplicate_lines(text),
            f"{mark}n_repeat_words": repeated_words(words),
            f"{mark}classes": classes,
            f"{mark}common": word_histogram(words),
        }
    )


def _means(mark: str, names: dict[str, int]) -> list[Column]:
    return [F.array(*[F.avg(F.col(f"{mark}{name}")[i]) for i in range(bins)]).alias(name) for name, bins in names.items()]


def references(measured: DataFrame, lang: str, mark: str) -> tuple[DataFrame, DataFrame]:
    """The mean histograms of each language (``lang, classes, common, vouches``), and in one row those of all (``classes``)."""
    long = measured.where(_long(mark)).select(F.col(lang).alias("lang"), F.col(f"{mark}classes"), F.col(f"{mark}common"))
    whole = long.agg(*_means(mark, {"classes": N_CLASSES})).scalar()
    apart = long.withColumn("first", whole).withColumn("d", js_distance(F.col(f"{mark}classes"), F.col("first")))
    # with a large part of junk the mean lies between; the half that is nearer to it is of the greater kind
    near = apart.where(F.col("d") <= apart.agg(F.avg("d").alias("d")).scalar())
    centre = stage(near.agg(*_means(mark, {"classes": N_CLASSES})), "centre").scalar()
    accepted = long.withColumn("first", centre).where(js_distance(F.col(f"{mark}classes"), F.col("first")) <= MOST_DISTANCE)
    both = {"classes": N_CLASSES, "common": len(COMMON) + 1}
    groups = accepted.groupBy("lang").agg(F.count("*").alias("n"), *_means(mark, both))
    groups = stage(groups, "references")
    total = groups.agg(F.sum("n").alias("n")).scalar()
    known = groups.where(F.col("lang").isNotNull() & (F.col("n") >= LEAST_LANGUAGE_DOCS))
    known = known.select("lang", "classes", "common", (F.col("n") >= VOUCHING_SHARE * total).alias("vouches"))
    # means of means weighed by their documents: the mean over all of them
    whole = groups.agg(F.array(*[F.sum(F.col("classes")[i] * F.col("n")) / F.sum("n") for i in range(N_CLASSES)]).alias("classes"))
    return known, whole


def _long(mark: str) -> Column:
    return (F.col(f"{mark}n_words") >= GUARD_WORDS) & (F.col(f"{mark}n_chars") >= GUARD_CHARS)


def _judged(measured: DataFrame, refs: tuple[DataFrame, DataFrame], lang: str, mark: str) -> DataFrame:
    """``measured`` with distances and verdict, in columns whose names begin with ``mark``."""
    known, whole = refs
    q = lambda name: F.col(f"{mark}{name}")
    vouching = known.where("vouches").agg(F.array_sort(F.collect_list(F.struct("lang", "classes", "common"))).alias("r"))
    own = known.select(F.col("lang").alias(f"{mark}lang"), F.struct("lang", "classes", "common").alias(f"{mark}own"))
    # a table with a row a language, joined as its size allows
    rows = join_small(measured, own, F.col(lang) == q("lang"))
    repeats = 100 * q("n_repeat_words") > MOST_REPEATED_PERCENT * q("n_words")
    rows = rows.withColumns({f"{mark}refs": vouching.scalar(), f"{mark}whole": whole.scalar(), f"{mark}base_failed": (q("n_words") < LEAST_WORDS) | repeats})
    rows = rows.withColumn(f"{mark}refs", F.when(q("own").isNotNull(), F.array_append(q("refs"), q("own"))).otherwise(q("refs")))

    def nearest(name: str) -> Column:
        return F.array_min(F.transform(q("refs"), lambda r: js_distance(q(name), r[name])))

    compared = ~q("base_failed") & _long(mark)
    full = F.col(lang).isNull() | q("own").isNotNull()
    rows = rows.withColumns(
        {
            f"{mark}class_distance": F.when(compared, F.when(full, nearest("classes")).otherwise(js_distance(q("classes"), q("whole")))),
            f"{mark}word_distance": F.when(compared & full, nearest("common")),
        }
    )
    words = F.coalesce(q("word_distance"), F.lit(0.0))
    distance = F.sqrt(q("class_distance") * q("class_distance") + words * words)
    far = distance > MOST_DISTANCE + SAMPLING_DISTANCE / F.sqrt(q("n_words"))
    return rows.withColumn(f"{mark}kept", ~q("base_failed") & ~F.coalesce(far, F.lit(False)))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row: id, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``,
    ``kept``, and the two distances (null where not compared).

    A null text counts as empty; texts below ``LEAST_WORDS`` words fail. Texts below the guards are kept when the base
    rules pass; those of a language without a reference have no word distance. Rows without a language are compared with
    the languages that vouch for all. Texts are measured whole, whatever their length, and once: their measures are staged.
    Repeated rows are judged each; other columns are not looked at. Without documents past the guards nothing is compared.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    measured = stage(_measured(rows, "text", "q_").drop("text", "q_text", "q_words"), "measured")
    judged = _judged(measured, references(measured, "lang", "q_"), "lang", "q_")
    return judged.select("doc_id", *[F.col(f"q_{n}").alias(n) for n in RESULTS])


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns, whatever their names; an empty table stays empty.

    Null, empty, short and very long texts and repeated rows are judged as in ``judge``. Texts are measured once and staged
    with their measures; the references read the measures alone.
    """
    mark = free_name(docs, "q_")
    measured = stage(_measured(docs, text_col, mark).drop(f"{mark}text", f"{mark}words"), "measured")
    rows = _judged(measured, references(measured, lang_col, mark), lang_col, mark)
    return rows.where(F.col(f"{mark}kept")).select(*docs.columns)
