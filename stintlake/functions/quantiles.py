"""Exact linear-interpolation quantiles without gathering a group in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.functions.ordered import OrderedGroups, SplitPolicy
from stintlake.session import stage


def group_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    quantiles: dict[str, float],
    policy: SplitPolicy | None = None,
) -> DataFrame:
    """One row per group with the exact ``quantiles`` of ``value`` (nulls left out).

    Equal values are counted before the shuffle; a running total over the
    distinct values then finds those at the wanted ranks. ``percentile`` keeps
    every distinct value of a group in one buffer, this keeps none.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    g = OrderedGroups(counted, keys, [value], policy)
    g = g.running(sums={"_upto": F.col("_n")})
    size = df.where(F.col(value).isNotNull())
    size = (size.groupBy(*keys) if keys else size).agg(F.count("*").alias("_size"))
    ranked = g.result()
    if keys:
        ranked = ranked.join(size, keys)
    else:
        ranked = ranked.withColumn("_size", size.scalar())
    aggs = []
    for name, q in quantiles.items():
        target = (F.col("_size") - 1) * F.lit(float(q))
        for tag, rank in (("lo", F.floor(target)), ("hi", F.ceil(target))):
            hit = (F.col("_upto") > rank) & (F.col("_upto") - F.col("_n") <= rank)
            aggs.append(F.max(F.when(hit, F.col(value).cast("double"))).alias(f"_{name}_{tag}"))
        aggs.append(F.max(target - F.floor(target)).alias(f"_{name}_part"))
    wide = ranked.groupBy(*keys).agg(*aggs)
    lo, hi, part = ("_{}_lo", "_{}_hi", "_{}_part")
    return wide.select(
        *keys,
        *[
            (
                F.col(lo.format(n))
                + (F.col(hi.format(n)) - F.col(lo.format(n))) * F.col(part.format(n))
            ).alias(n)
            for n in quantiles
        ],
    )


def column_quantiles(
    df: DataFrame, cols: list[str], quantiles: list[float], accuracy: int = 4000
) -> DataFrame:
    """Exact quantiles of whole columns: rows ``(column, q<i>, ..)``, one per column.

    A sketch pass brackets every quantile. A second pass counts the values, each of those inside a bracket by itself and the
    others by which brackets they lie below; what it gives is staged and small, and the ranks are found in it. ``df`` is read
    twice. A bracket that misses its rank by more than the value next to it stops the job rather than give a wrong value.
    """
    names = [f"q{i}" for i in range(len(quantiles))]
    margin = 4.0 / accuracy
    probs = [p for q in quantiles for p in (max(0.0, q - margin), min(1.0, q + margin))]
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    sketch = doubles.agg(
        F.array(*[F.percentile_approx(c, [float(p) for p in probs], accuracy) for c in cols]).alias("_sketch")
    )
    sketch = stage(sketch, "sketch")
    every = range(len(quantiles))

    # one narrow row per value: an aggregate with hundreds of columns is not compiled
    values = doubles.select(F.inline(F.array(*[F.struct(F.lit(j).alias("_j"), F.col(c).alias("_v")) for j, c in enumerate(cols)])))
    v, bounds = F.col("_v"), F.col("_range")
    low, high = [F.get(bounds, F.lit(2 * i)) for i in every], [F.get(bounds, F.lit(2 * i + 1)) for i in every]
    within = reduce(lambda a, b: a | b, [v.between(low[i], high[i]) for i in every])
    side = reduce(lambda a, b: a + b, [F.when(v < low[i], F.lit(1 << i)).otherwise(F.lit(0)) for i in every])
    counted = values.where(v.isNotNull()).withColumn("_range", F.get(sketch.scalar(), F.col("_j")))
    counted = counted.select("_j", v, F.when(within, v).alias("_at"), F.when(~within, side).alias("_side"))
    counted = counted.groupBy("_j", "_at", "_side").agg(F.count("*").alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    counted = stage(counted, "counted")

    asked = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(j).alias("_j"), F.lit(i).alias("_i")) for j, c in enumerate(cols) for i in every])
    asked = sketch.select(F.inline(asked)).withColumn("_range", F.get(sketch.scalar(), F.col("_j")))
    asked = asked.select("column", "_j", "_i", F.get("_range", 2 * F.col("_i")).alias("_low"), F.get("_range", 2 * F.col("_i") + 1).alias("_high"))
    met = asked.join(counted, "_j", "left")
    under, over = F.col("_most") < F.col("_low"), F.col("_least") > F.col("_high")
    below = met.groupBy("column", "_i").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_size"),
        F.coalesce(F.sum(F.when(under, F.col("_n"))), F.lit(0)).alias("_below"),
        F.max(F.when(under, F.col("_most"))).alias("_under"),
        F.min(F.when(over, F.col("_least"))).alias("_over"),
    )
    inside = met.where(F.col("_at").between(F.col("_low"), F.col("_high"))).select("column", "_i", F.col("_at").alias("_v"), "_n")
    ranked = OrderedGroups(inside, ["column", "_i"], ["_v"]).running(sums={"_in": F.col("_n")}).result()
    q_of = F.get(F.array(*[F.lit(float(q)) for q in quantiles]), F.col("_i"))
    target = (F.col("_size") - 1) * q_of
    upto = F.col("_below") + F.col("_in")

    def at(rank):
        return F.max(F.when((upto > rank) & (upto - F.col("_n") <= rank), F.col("_v")))

    found = (
        below.join(ranked, ["column", "_i"], "left")
        .groupBy("column", "_i", "_size", "_below", "_under", "_over")
        .agg(
            at(F.floor(target)).alias("_lo"),
            at(F.ceil(target)).alias("_hi"),
            F.coalesce(F.max(upto), F.col("_below")).alias("_top"),
        )
        .withColumn("_part", target - F.floor(target))
    )
    # in a short column the bracket may be a single value, and one of the two ranks the value next to it
    for end, rank in (("_lo", F.floor(target)), ("_hi", F.ceil(target))):
        beside = F.when(rank == F.col("_top"), F.col("_over")).when(rank == F.col("_below") - 1, F.col("_under"))
        found = found.withColumn(end, F.coalesce(F.col(end), beside))
    value = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_part")
    checked = F.when(
        (F.col("_size") > 0) & (F.col("_lo").isNull() | F.col("_hi").isNull()),
        F.raise_error(F.lit("quantile bracket missed its rank; raise accuracy")).cast("double"),
    ).otherwise(value)
    return (
        found.withColumn("_q", checked)
        .groupBy("column")
        .agg(*[F.max(F.when(F.col("_i") == i, F.col("_q"))).alias(n) for i, n in enumerate(names)])
    )


def quantile_struct(df: DataFrame, cols: list[str], quantiles: list[float]) -> DataFrame:
    """The same as one row and one struct column, for use as a scalar subquery."""
    wide = column_quantiles(df, cols, quantiles)
    return wide.agg(
        F.struct(
            *[
                F.max(F.when(F.col("column") == c, F.col(f"q{i}"))).alias(f"{c}_q{i}")
                for c in cols
                for i in range(len(quantiles))
            ]
        ).alias("_quantiles")
    )
