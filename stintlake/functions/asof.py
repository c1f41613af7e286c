"""Time-aligned lookups as one sorted pass instead of range joins.

A range or nearest join on a shared race key pairs every lap with every sample
of the race. Here both sides are put in one table ordered by time, and running
values carry what is needed from the samples to the points: the work is one
exchange and one sort, whatever the length of the intervals.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlake.functions import exact, ordered
from stintlake.functions.ordered import OrderedGroups, SplitPolicy, join_same
from stintlake.session import stage


@dataclass(frozen=True)
class Samples:
    """A table to look values up in: its time column, the values, and what orders samples at one time.

    With ``tie``, the first of the samples at one time counts.
    """

    df: DataFrame
    time: str
    values: list[str]
    tie: str | None = None

    def packed(self, keys: list[str]) -> DataFrame:
        time = F.col(self.time).cast("double")
        picked = self.df.where(time.isNotNull()).select(
            *keys,
            time.alias("_t"),
            F.struct(time.alias("sample_time"), *self.values).alias("_sample"),
            *([F.col(self.tie).alias("_tie")] if self.tie else []),
        )
        if not self.tie:
            return picked
        return picked.groupBy(*keys, "_t").agg(F.min_by("_sample", "_tie").alias("_sample"))


def align(
    points: DataFrame,
    keys: list[str],
    time: str,
    point_id: list[str],
    samples: dict[str, Samples],
    how: dict[str, str] | str = "nearest",
    policy: SplitPolicy | None = None,
) -> DataFrame:
    """``points`` with one struct column per entry of ``samples``, null when nothing matches.

    ``backward`` takes the last sample at or before the point, ``forward`` the
    first at or after it, ``nearest`` the closer of the two and the earlier on
    equal distance. ``point_id`` orders points at the same time. All tables
    share one exchange on ``keys``; points with a null time keep nulls.
    """
    hows = {n: how if isinstance(how, str) else how[n] for n in samples}
    both = points.select(
        *keys,
        F.col(time).cast("double").alias("_t"),
        F.lit(1).alias("_kind"),
        F.struct(*[F.col(c) for c in point_id]).alias("_id"),
        F.struct(*points.columns).alias("_point"),
    )
    for n, s in samples.items():
        packed = s.packed(keys).withColumnRenamed("_sample", f"_s_{n}").withColumn("_kind", F.lit(0))
        both = both.unionByName(packed, allowMissingColumns=True)
    # a sample at the very time of a point sorts before it, so "forward" looks back as well
    g = OrderedGroups(both, keys, ["_t", "_kind", "_id"], policy).running(
        lasts={f"_back_{n}": F.col(f"_s_{n}") for n in samples},
        nexts={f"_ahead_{n}": F.col(f"_s_{n}") for n in samples if hows[n] != "backward"},
    )
    t = F.col("_t")

    def match(n: str) -> Column:
        back, ahead = F.col(f"_back_{n}"), F.col(f"_ahead_{n}")
        if hows[n] == "backward":
            found = back
        elif hows[n] == "forward":
            found = F.when(back["sample_time"] == t, back).otherwise(ahead)
        else:
            behind, before = t - back["sample_time"], ahead["sample_time"] - t
            found = F.when(behind.isNull() | (before < behind), ahead).otherwise(back)
        return F.when(t.isNotNull(), found).alias(n)

    return g.result().where(F.col("_kind") == 1).select("_point.*", *[match(n) for n in samples])


def interval_stats(
    spans: DataFrame,
    samples: DataFrame,
    keys: list[str],
    span_id: list[str],
    start: str,
    end: str,
    sample_time: str,
    means: list[str],
    any_true: list[str],
    lasts: list[str] | None = None,
    sample_tie: str | None = None,
    policy: SplitPolicy | None = None,
) -> DataFrame:
    """Statistics of the samples inside the closed interval ``[start, end]`` of every span.

    Gives one row per span that has both times: ``keys``, ``span_id``, ``n``,
    ``<c>_mean`` for ``means``, ``<c>_any`` for ``any_true``, ``<c>_last`` for
    the last sample, and the structs ``before`` and ``after`` with the samples
    next to ``start``. Infinite and not-a-number values of ``means`` are null.
    Means are differences of exact running totals, so that no span is ever paired
    with its samples, and no sample outside a span changes its mean by a bit.
    """
    # there are few races, several meet in one task, and their rows grow with the totals
    policy = (policy or ordered.DEFAULT_POLICY).shared(2)
    lasts = lasts or []
    values = list(dict.fromkeys(means + any_true + lasts))
    samples = samples.withColumns({c: exact.finite(c) for c in means if dict(samples.dtypes)[c] in ("double", "float")})
    found = exact.bands(samples.where(F.col(sample_time).isNotNull()), means)
    sample = F.struct(F.col(sample_time).cast("double").alias("sample_time"), *values)
    # totals run over the samples alone and are staged by the sample's place in its group; spans find their places in rows
    # of a few numbers and look the totals up by place, so that nothing wide is sorted with the spans
    totals = {}
    for c in means:
        totals |= {f"sum_{c}_{i}": exact.part(F.col(f"_of_{c}"), band) for i, band in enumerate(found[c])}
        totals[f"cnt_{c}"] = F.col(c).isNotNull().cast("long")
    for c in any_true:
        totals[f"any_{c}"] = F.coalesce(F.col(c), F.lit(False)).cast("long")
    tie = [sample_tie] if sample_tie else []
    seen = samples.where(F.col(sample_time).isNotNull()).select(
        *keys, *dict.fromkeys([sample_time, *tie, *values]), sample.alias("_sample")
    )
    if means:
        seen = seen.withColumns({f"_of_{c}": exact.chunks(c) for c in means})
    g = OrderedGroups(seen, keys, [sample_time, *tie], policy)
    # of several samples at one time the first is the one before a start
    again = {"_again": lambda w: F.lag(sample_time).over(w) == F.col(sample_time), "_next": lambda w: F.lead("_sample").over(w)}
    g = g.frames(again, before=1, after=1)
    first = F.when(~F.coalesce(F.col("_again"), F.lit(False)), F.col("_sample"))
    sums = {"_place": F.lit(1).cast("long")} | {f"_t_{n}": c for n, c in totals.items()}
    g = g.running(sums=sums, lasts={"_first": first})
    total = F.struct(*[F.col(f"_t_{n}").alias(n) for n in totals])
    marks = stage(g.result().select(*keys, "_place", "_sample", "_first", "_next", total.alias("_total")), "marks")
    # at equal times: starts, then samples, then ends, which closes the interval on both sides
    edges = spans.where(F.col(start).isNotNull() & F.col(end).isNotNull())
    left = edges.select(
        *keys,
        *span_id,
        F.explode(
            F.array(
                F.struct(F.col(start).cast("double").alias("_t"), F.lit(0).alias("_kind")),
                F.struct(F.col(end).cast("double").alias("_t"), F.lit(2).alias("_kind")),
            )
        ).alias("_edge"),
    ).select(*keys, *span_id, "_edge.*")
    right = marks.select(*keys, F.col("_sample.sample_time").alias("_t"), F.lit(1).alias("_kind"))
    both = left.unionByName(right, allowMissingColumns=True)
    placed = OrderedGroups(both, keys, ["_t", "_kind", *span_id], policy).running(sums={"_place": (F.col("_kind") == 1).cast("long")})
    places = {"_from": F.max(F.when(F.col("_kind") == 0, F.col("_place"))), "_to": F.max(F.when(F.col("_kind") == 2, F.col("_place")))}
    per_span = placed.result().where(F.col("_kind") != 1).groupBy(*keys, *span_id).agg(*[c.alias(n) for n, c in places.items()])
    # place 0 is before the first sample
    before_all = marks.where(F.col("_place") == 1).select(*keys, F.lit(0).cast("long").alias("_from"), F.col("_sample").alias("_next"))
    starts = marks.select(*keys, F.col("_place").alias("_from"), "_first", "_next", F.col("_total").alias("_before"))
    starts = starts.unionByName(before_all, allowMissingColumns=True)
    ends = marks.select(*keys, F.col("_place").alias("_to"), F.col("_total").alias("_until"), *([F.col("_sample").alias("_last")] if lasts else []))
    per_span = join_same(join_same(per_span, ends, [*keys, "_to"], "left"), starts, [*keys, "_from"], "left")
    n = F.col("_to") - F.col("_from")

    def span(name: str) -> Column:
        return F.coalesce(F.col(f"_until.{name}"), F.lit(0)) - F.coalesce(F.col(f"_before.{name}"), F.lit(0))

    return per_span.select(
        *keys,
        *span_id,
        n.alias("n"),
        *[
            F.try_divide(exact.total({b: span(f"sum_{c}_{i}") for i, b in enumerate(found[c])}), span(f"cnt_{c}")).alias(f"{c}_mean")
            for c in means
        ],
        *[F.when(n > 0, span(f"any_{c}") > 0).alias(f"{c}_any") for c in any_true],
        *[F.when(n > 0, F.col(f"_last.{c}")).alias(f"{c}_last") for c in lasts],
        F.col("_first").alias("before"),
        F.col("_next").alias("after"),
    )


def nearest_of(before: str, after: str, time: Column, field: str) -> Column:
    """Field of the closer of two sample structs, the earlier one on equal distance."""
    behind, ahead = time - F.col(f"{before}.sample_time"), F.col(f"{after}.sample_time") - time
    return F.when(behind.isNull() | (ahead < behind), F.col(f"{after}.{field}")).otherwise(
        F.col(f"{before}.{field}")
    )
