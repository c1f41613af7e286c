"""Values that hold for a stretch of a time grid: samples become intervals, several tables of them become one.

The nearest of some samples changes only at the middle between two of them. A grid of half seconds over a race is therefore
a few stretches per sample, not thousands of points: what is nearest, who is next to whom and how far away is found per
stretch, and points are made, if at all, at the very end. Stretches run from the tick ``from`` to before the tick
``until``; tick k is the time k times ``step``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlake.functions.asof import Samples
from stintlake.functions import exact
from stintlake.functions.exact import finite
from stintlake.functions.ordered import OrderedGroups, SplitPolicy, join_same
from stintlake.session import stage

#: Ticks of a bin in which intervals are paired, and of a run of points.
BIN = 600
RUN = 7200


def _tick_after_middle(a: Column, b: Column, step: float) -> Column:
    """The first tick that is nearer to ``b`` than to the earlier ``a``; at equal distance ``a`` counts."""
    near = F.floor((a + b) / (2 * step))

    def later(k: Column) -> Column:
        return (k * F.lit(step) - a) > (b - k * F.lit(step))

    return F.when(later(near), near).when(later(near + 1), near + 1).otherwise(near + 2)


def nearest_steps(
    base: DataFrame, keys: list[str], samples: dict[str, Samples], step: float, policy: SplitPolicy | None = None
) -> DataFrame:
    """``keys, from, until`` and a struct per entry of ``samples`` with the values nearest to every tick of the stretch.

    ``base`` has a row per group with its ``last`` tick; groups without one are left out, groups without samples have null
    structs. Of samples at one time the first by ``tie`` counts. One exchange on ``keys`` and two sorts, whatever the step.
    """
    ties = {n: f"_tie_{n}" for n, s in samples.items() if s.tie}
    empty = F.lit(None)
    parts = [base.select(*keys, empty.cast("double").alias("_t"), F.lit(-1).alias("_kind"), F.col("last").cast("long").alias("_last"))]
    for i, (n, s) in enumerate(samples.items()):
        time = finite(s.time)
        tie = [F.col(s.tie).alias(ties[n])] if s.tie else []
        parts.append(s.df.where(time.isNotNull()).select(*keys, time.alias("_t"), F.lit(i).alias("_kind"), *tie, F.struct(*s.values).alias(f"_v_{n}")))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    kind, t = F.col("_kind"), F.col("_t")
    g = OrderedGroups(rows, keys, ["_t", "_kind", *ties.values()], policy)
    g = g.running(lasts={f"_p_{n}": F.when(kind == i, t) for i, n in enumerate(samples)}, own=False)
    before = F.coalesce(*[F.when(kind == i, F.col(f"_p_{n}")) for i, n in enumerate(samples)])
    tick = F.when(before.isNull(), F.lit(0)).when(before < t, F.greatest(F.lit(0), _tick_after_middle(before, t, step)))
    g = g.add({"_tick": tick.cast("long")})
    g = g.add({f"_v_{n}": F.when(F.col("_tick").isNotNull(), F.col(f"_v_{n}")) for n in samples})
    g = g.regroup(keys, ["_tick", "_t", "_kind", *ties.values()])
    return _stretches(g, keys, {n: F.col(f"_v_{n}") for n in samples})


def _stretches(g: OrderedGroups, keys: list[str], values: dict[str, Column]) -> DataFrame:
    """What holds from each ``_tick`` to the next, out of changes in order; of changes at one tick the last row has them all."""
    g = g.running(lasts={**values, "_upto": F.col("_last")}).frames({"_next": lambda w: F.lead("_tick").over(w)}, after=1)
    end = F.col("_upto") + 1
    until = F.when(F.col("_upto").isNotNull(), F.least(F.coalesce("_next", end), end))  # null in groups that base has not
    return g.result().select(*keys, F.col("_tick").alias("from"), until.alias("until"), *values).where(F.col("from") < F.col("until"))


def merged(base: DataFrame, keys: list[str], steps: dict[str, tuple[DataFrame, str]], policy: SplitPolicy | None = None) -> DataFrame:
    """``keys, from, until`` and a column per entry of ``steps``, from tables of stretches with the named column.

    A table's stretches must not overlap in a group; where it has none the value is null. ``base`` is as above.
    """
    parts = [base.select(*keys, F.lit(0).cast("long").alias("_tick"), F.lit(0).alias("_kind"), F.col("last").cast("long").alias("_last"))]
    for n, (table, column) in steps.items():
        on = F.struct(F.col("from").alias("_tick"), F.lit(2).alias("_kind"), F.struct(F.col(column).alias("v")).alias(f"_v_{n}"))
        off = F.struct(
            F.col("until").alias("_tick"), F.lit(1).alias("_kind"), F.struct(F.lit(None).cast(table.schema[column].dataType).alias("v")).alias(f"_v_{n}")
        )
        parts.append(table.select(*keys, F.explode(F.array(on, off)).alias("_e")).select(*keys, "_e.*"))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    g = OrderedGroups(rows, keys, ["_tick", "_kind"], policy)
    found = _stretches(g, keys, {f"_v_{n}": F.col(f"_v_{n}") for n in steps})
    return found.select(*keys, "from", "until", *[F.col(f"_v_{n}.v").alias(n) for n in steps])


def _binned(df: DataFrame, width: int) -> DataFrame:
    first, last = F.floor(F.col("from") / width), F.floor((F.col("until") - 1) / width)
    return df.withColumn("_bin", F.explode(F.sequence(first, last)))


def overlaps(left: DataFrame, right: DataFrame, on: list[str], width: int = BIN) -> DataFrame:
    """The common part of every two stretches of a group, with the columns of both.

    Stretches are paired by group and bin of ``width`` ticks, so that only those near each other meet; each pair is found in
    the bin in which its common part begins.
    """
    names = {c: f"_r_{c}" for c in (*on, "from", "until", "_bin")}
    other = _binned(right, width).withColumnsRenamed(names)
    same = [F.col(c) == F.col(names[c]) for c in (*on, "_bin")]
    start, end = F.greatest("from", "_r_from"), F.least("until", "_r_until")
    met = _binned(left, width).join(other, reduce(lambda a, b: a & b, same))
    met = met.where((start < end) & (F.floor(start / width) == F.col("_bin")))
    return met.withColumns({"from": start, "until": end}).drop("_bin", *names.values())


def first_of(stretches: DataFrame, keys: list[str], name: str, policy: SplitPolicy | None = None) -> DataFrame:
    """``keys, from, until, name``: the least ``name`` among the stretches of a group that hold at a time."""
    ends = stretches.select(*keys, F.explode(F.array("from", "until")).alias("from")).distinct()
    cut = OrderedGroups(ends, keys, ["from"], policy).frames({"until": lambda w: F.lead("from").over(w)}, after=1).result()
    met = overlaps(cut.where("until is not null"), stretches.select(*keys, "from", "until", name), keys)
    return met.groupBy(*keys, "from", "until").agg(F.min(name).alias(name))


#: Values that no sum of whole numbers holds, by the name of their count.
ODD = {"nan": float("nan"), "up": float("inf"), "down": float("-inf")}


def with_sums(
    rows: DataFrame, steps: DataFrame, keys: list[str], means: list[str], counts: list[str], policy: SplitPolicy | None = None
) -> DataFrame:
    """Stretches ``rows`` with exact sums over their ticks of what ``steps`` have there, as the struct ``_sums``.

    ``steps`` are a group's stretches, which do not overlap. Running totals up to each of them are staged by place; both ends of
    a row find their place in narrow rows and look the totals up, so a row is never paired with the stretches it spans. Of
    ``means`` there are values and how many, of ``counts`` (whole numbers) values; ``added`` and ``averaged`` go on from there.
    """
    steps = stage(steps, "steps")
    found = exact.bands(steps, means)
    length, each = F.col("until") - F.col("from"), {}
    for c in means:
        each |= {f"sum_{c}_{b}": exact.part(F.col(f"_of_{c}"), b) for b in found[c]}
        each[f"cnt_{c}"] = F.col(c).isNotNull().cast("long")
        each |= {f"{odd}_{c}": F.coalesce(F.col(c).cast("double") == value, F.lit(False)).cast("long") for odd, value in ODD.items()}
    each |= {f"cnt_{c}": F.coalesce(F.col(c), F.lit(0)).cast("long") for c in counts}
    cut = steps.withColumns({f"_of_{c}": exact.chunks(c) for c in means})
    cut = cut.select(*keys, F.col("from").alias("_begin"), F.col("until").alias("_end"), *[(e * length).alias(f"_t_{n}") for n, e in each.items()], *[e.alias(f"_e_{n}") for n, e in each.items()])
    g = OrderedGroups(cut, keys, ["_begin"], policy)
    g = g.running(sums={"_place": F.lit(1).cast("long")} | {f"_u_{n}": F.col(f"_t_{n}") for n in each})
    marks = g.result().select(*keys, "_place", "_begin", "_end", *[F.struct(F.col(f"_u_{n}").alias("upto"), F.col(f"_e_{n}").alias("one")).alias(n) for n in each])
    marks = stage(marks, "totals")
    rows = stage(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    ends = F.array(F.struct(F.lit(0).alias("_kind"), F.col("from").alias("_tick")), F.struct(F.lit(2).alias("_kind"), F.col("until").alias("_tick")))
    left = rows.select(*keys, "_row", F.explode(ends).alias("_e")).select(*keys, "_row", "_e.*")
    # a place holds from its first tick on
    right = marks.select(*keys, F.col("_begin").alias("_tick"), F.lit(-1).alias("_kind"))
    both = left.unionByName(right, allowMissingColumns=True)
    placed = OrderedGroups(both, keys, ["_tick", "_kind", "_row"], policy).running(sums={"_place": (F.col("_kind") == -1).cast("long")})
    placed = placed.result().where("_kind >= 0").groupBy("_row").agg(
        F.max(F.when(F.col("_kind") == 0, F.col("_place"))).alias("_p0"), F.max(F.when(F.col("_kind") == 2, F.col("_place"))).alias("_p2")
    )
    done = rows.join(placed, "_row")
    for place, tick in (("_p0", "from"), ("_p2", "until")):
        at = marks.withColumnsRenamed({"_place": place, "_begin": f"{place}_begin", "_end": f"{place}_end"} | {n: f"{place}_{n}" for n in each})
        done = join_same(done, at, [*keys, place], "left")
        # what the stretch has after the tick is taken off again
        late = F.greatest(F.col(f"{place}_end") - F.col(tick), F.lit(0))
        upto = {n: F.coalesce(F.col(f"{place}_{n}.upto") - late * F.col(f"{place}_{n}.one"), F.lit(0)) for n in each}
        done = done.withColumn(f"{place}_at", F.struct(*[c.alias(n) for n, c in upto.items()]))
        done = done.drop(f"{place}_begin", f"{place}_end", *[f"{place}_{n}" for n in each])
    sums = F.struct(*[(F.col(f"_p2_at.{n}") - F.col(f"_p0_at.{n}")).alias(n) for n in each])
    return done.withColumn("_sums", sums).drop("_row", "_p0", "_p2", "_p0_at", "_p2_at")


def added(rows: DataFrame, means: list[str], counts: list[str]) -> list[Column]:
    """Aggregates of the ``_sums`` of rows: a struct of sums per column of ``means``, a number per column of ``counts``."""
    names = rows.schema["_sums"].dataType.fieldNames()
    parts = []
    for c in means:
        own = [n for n in names if n.startswith(f"sum_{c}_") or n in (f"cnt_{c}", *[f"{odd}_{c}" for odd in ODD])]
        parts.append(F.struct(*[F.sum(f"_sums.{n}").alias(n) for n in own]).alias(c))
    return [*parts, *[F.sum(f"_sums.cnt_{c}").alias(c) for c in counts]]


def averaged(parts: DataFrame, means: list[str]) -> DataFrame:
    """The means out of what ``added`` has made; null without values, and not-a-number or infinite where a value was."""
    done = {}
    for c in means:
        of = lambda n, c=c: F.col(f"{c}.{n}")
        whole = exact.total({int(n.rsplit("_", 1)[1]): of(n) for n in parts.schema[c].dataType.fieldNames() if n.startswith("sum_")})
        nan, up, down = (of(f"{odd}_{c}") > 0 for odd in ODD)
        value = F.when(nan | (up & down), float("nan")).when(up, float("inf")).when(down, float("-inf")).otherwise(F.try_divide(whole, of(f"cnt_{c}")))
        done[c] = F.when(of(f"cnt_{c}") > 0, value)
    return parts.withColumns(done)


def points(stretches: DataFrame, step: float, name: str = "t") -> DataFrame:
    """Every tick of every stretch as a row with its time, made in runs of ``RUN``."""
    runs = F.sequence(F.col("from"), F.col("until") - 1, F.lit(RUN).cast("long"))
    cut = stretches.withColumn("_run", F.explode(runs))
    ticks = F.sequence(F.col("_run"), F.least(F.col("until"), F.col("_run") + RUN) - 1)
    made = cut.withColumn("_tick", F.explode(ticks)).withColumn(name, F.col("_tick") * F.lit(step))
    return made.drop("_run", "_tick", "from", "until")
