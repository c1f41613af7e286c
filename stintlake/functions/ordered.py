"""Ordered groups whose window functions survive a hot key.

A Spark window puts a whole partition key into one task. Races, laps and even a
single car can hold a large part of a table, so the helpers here first look at
the key distribution in a random sample of the rows. When no group is oversized,
the plan is the plain window: one exchange on the key. Otherwise the rows are
dealt out by ranges of (keys, order) to partitions of about ``max_rows`` rows
and staged; the part of a group that lies in one partition is a block, and every
block is a window partition of its own. Frames of a fixed number of rows get the
few rows they miss from the neighbouring blocks; running totals and fills get a
carry from a table of one row per block. Only a partition's first and last group
can be cut, so all such tables have a few rows for each partition, are staged,
and are joined as the planner sees fit. Results are exact wherever the cuts fall.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stintlake.functions.joins import join_small
from stintlake.session import stage

BLOCK = "_block"
_BLOCKS = "_blocks"
_HALO = "_halo"
_MARK = "_mark"


@dataclass(frozen=True)
class SplitPolicy:
    """When and how finely groups are cut.

    ``max_rows`` rows of up to ``max_bytes`` in all are fine for one task, whatever
    the size of the table; one row in ``sample_every`` is looked at, chosen at random.
    """

    max_rows: int = 2_000_000
    sample_every: int = 512
    max_bytes: int = 128 << 20

    def rows(self, df: DataFrame) -> int:
        """How many rows of ``df`` are fine for one task."""
        return max(1, min(self.max_rows, self.max_bytes // _width(df.schema)))

    def shared(self, groups: int) -> SplitPolicy:
        """The same where a task gets up to so many of the largest groups, as a hash deals few groups unevenly."""
        return replace(self, max_bytes=self.max_bytes // groups)


def _width(kind: T.DataType) -> int:
    """Bytes of a value in a row, about."""
    if isinstance(kind, T.StructType):
        return 8 + sum(_width(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return 16 + 10 * _width(kind.elementType)
    if isinstance(kind, T.MapType):
        return 32 + 10 * (_width(kind.keyType) + _width(kind.valueType))
    return 32 if isinstance(kind, (T.StringType, T.BinaryType)) else 8


DEFAULT_POLICY = SplitPolicy()


def set_default_policy(policy: SplitPolicy) -> SplitPolicy:
    """Replace the policy used when an operator gets none; returns the previous one."""
    global DEFAULT_POLICY
    previous, DEFAULT_POLICY = DEFAULT_POLICY, policy
    return previous


def join_same(left: DataFrame, right: DataFrame, cols: list[str], how: str) -> DataFrame:
    """Null-safe join on equally named columns, keeping one copy of them."""
    names = {c: f"_r{i}" for i, c in enumerate(cols)}
    right = right.withColumnsRenamed(names)
    on = reduce(
        lambda a, b: a & b,
        [F.col(c).eqNullSafe(F.col(r)) for c, r in names.items()],
        F.lit(True),
    )
    return left.join(right, on, how).drop(*names.values())


def _row_mark(df: DataFrame) -> Column:
    """Hash of a whole row; equal only for rows that are equal, or nearly never."""
    plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*[F.col(f"`{c}`") for c in plain])


_FITTING: ContextVar[tuple[frozenset[str], ...]] = ContextVar("fitting", default=())


@contextmanager
def looked_at(df: DataFrame, *keys: list[str], policy: SplitPolicy | None = None) -> Iterator[None]:
    """Look at the groups of ``df`` once for several steps.

    Inside, steps that keep its rows or drop some need not look again at groups
    of ``keys``, or of more keys, where none was oversized.
    """
    fit = [frozenset(k) for k in keys if not _oversized(df, k, policy or DEFAULT_POLICY)]
    token = _FITTING.set((*_FITTING.get(), *fit))
    try:
        yield
    finally:
        _FITTING.reset(token)


def _sample(df: DataFrame, keys: list[str], policy: SplitPolicy) -> DataFrame:
    """A random share of the rows, whatever their values; only the keys are read."""
    return df.select(*keys).sample(1.0 / policy.sample_every, seed=7)


def _oversized(df: DataFrame, keys: list[str], policy: SplitPolicy) -> bool:
    sizes = _sample(df, keys, policy).groupBy(*keys).agg(F.count("*").alias("_n"))
    return not sizes.where(F.col("_n") * policy.sample_every > policy.rows(df)).isEmpty()


class OrderedGroups:
    """``df`` seen as groups of ``keys``, each ordered by ``order`` (ascending, nulls first).

    ``order`` should be unique inside a group, as in any deterministic window.
    The methods return a new object with columns added; ``result()`` gives the
    DataFrame.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: list[str],
        order: list[str],
        policy: SplitPolicy | None = None,
    ):
        self.keys, self.order = list(keys), list(order)
        self.policy = policy or DEFAULT_POLICY
        parts = self._parts(df)
        self.split = parts > 0
        self.df = self._cut(df, parts) if self.split else df
        self._staged = self.split

    # -- where to cut ------------------------------------------------------

    def _parts(self, df: DataFrame) -> int:
        """Partitions to deal the rows to; 0 when every group fits into a task."""
        p = self.policy
        if any(known <= set(self.keys) for known in _FITTING.get()) or not _oversized(df, self.keys, p):
            return 0
        return math.ceil(_sample(df, self.keys, p).count() * p.sample_every / p.rows(df))

    def _cut(self, df: DataFrame, parts: int) -> DataFrame:
        """The rows, staged, with their block's number in the group and the group's blocks; 0 and null if not cut."""
        part = F.spark_partition_id().alias("_part")
        ranged = df.withColumn(_MARK, _row_mark(df)).repartitionByRange(parts, *self.keys, *self.order, _MARK)
        rows = stage(ranged.select("*", part), "blocks")
        group = F.struct(F.lit(0).alias("_all"), *self.keys)
        ends = rows.groupBy("_part").agg(F.min(group).alias("_low"), F.max(group).alias("_high"))
        ends = ends.select("_part", F.explode(F.array_distinct(F.array("_low", "_high"))).alias("_g"))
        ends = ends.select("_part", *[F.col(f"_g.{k}").alias(k) for k in self.keys])
        across = Window.partitionBy(*self.keys)
        blocks = ends.select(
            "*",
            (F.row_number().over(across.orderBy("_part")) - 1).alias(BLOCK),
            F.count("*").over(across).cast("int").alias(_BLOCKS),
        )
        blocks = stage(blocks.where(F.col(_BLOCKS) > 1), "cuts")
        joined = join_same(rows, blocks, [*self.keys, "_part"], "left").drop("_part")
        return joined.withColumn(BLOCK, F.coalesce(BLOCK, F.lit(0)))

    # -- windows -----------------------------------------------------------

    def _with(self, df: DataFrame) -> OrderedGroups:
        other = object.__new__(OrderedGroups)
        other.__dict__.update(self.__dict__)
        other.df, other._staged = df, False
        return other

    def _settled(self) -> OrderedGroups:
        """Cut groups are read several times per step; a chain of steps is staged in between."""
        if not self.split or self._staged:
            return self
        other = self._with(stage(self.df, "blocks"))
        other._staged = True
        return other

    def _window(self, backward: bool = False) -> WindowSpec:
        keys = self.keys + [BLOCK] if self.split else self.keys
        names = [*self.order, _MARK] if self.split else self.order
        order = [F.desc(c) for c in names] if backward else names
        return (Window.partitionBy(*keys) if keys else Window).orderBy(*order)

    def _summary(self, aggs: dict[str, Column]) -> DataFrame:
        """One row per block of the groups that were cut."""
        whole = self.df.where(F.col(_BLOCKS).isNotNull()).groupBy(*self.keys, BLOCK)
        return whole.agg(*[c.alias(n) for n, c in aggs.items()])

    def _block_window(self, backward: bool = False) -> WindowSpec:
        order = F.desc(BLOCK) if backward else F.asc(BLOCK)
        return (Window.partitionBy(*self.keys) if self.keys else Window).orderBy(order)

    def frames(
        self, exprs: dict[str, Callable[[WindowSpec], Column]], before: int = 0, after: int = 0
    ) -> OrderedGroups:
        """Add window columns that look at most ``before`` rows back and ``after`` rows ahead."""
        self = self._settled()
        w = self._window()
        columns = {n: f(w) for n, f in exprs.items()}
        if not self.split:
            return self._with(self.df.withColumns(columns))
        rows = self.df.withColumn(_HALO, F.lit(False))
        for n_rows, forward in ((before, True), (after, False)):
            if n_rows:
                rows = rows.unionByName(self._halo(n_rows, forward))
        done = rows.withColumns(columns).where(~F.col(_HALO)).drop(_HALO)
        return self._with(done)

    def _halo(self, n_rows: int, forward: bool) -> DataFrame:
        """Copies of edge rows for the blocks after (``forward``) or before their own.

        A row goes to a block when fewer than ``n_rows`` rows lie between them,
        so blocks shorter than the frame are served from further away.
        """
        ends = self._summary({"_n": F.count("*")}).withColumn(
            "_end", F.sum("_n").over(self._block_window().rowsBetween(Window.unboundedPreceding, 0))
        ).withColumn("_start", F.col("_end") - F.col("_n")).drop("_n")
        keys = self.keys + [BLOCK]
        order = [F.desc(c) if forward else F.asc(c) for c in (*self.order, _MARK)]
        ends = stage(ends, "ends")
        edge = (
            self.df.where(F.col(_BLOCKS).isNotNull())
            .withColumn("_edge", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
            .where(F.col("_edge") <= n_rows)
        )
        edge = join_same(edge, ends.withColumnsRenamed({"_start": "_from", "_end": "_to"}), keys, "inner")
        if forward:
            first, last = F.col(BLOCK) + 1, F.least(F.col(BLOCK) + n_rows, F.col(_BLOCKS) - 1)
        else:
            first, last = F.greatest(F.col(BLOCK) - n_rows, F.lit(0)), F.col(BLOCK) - 1
        edge = edge.where(first <= last).withColumn(BLOCK, F.explode(F.sequence(first, last)))
        edge = join_same(edge, ends, keys, "inner")
        gap = F.col("_start") - F.col("_to") if forward else F.col("_from") - F.col("_end")
        return (
            edge.where(gap + F.col("_edge") - 1 < n_rows)
            .drop("_edge", "_from", "_to", "_start", "_end")
            .withColumn(_HALO, F.lit(True))
        )

    def running(
        self,
        sums: dict[str, Column] | None = None,
        lasts: dict[str, Column] | None = None,
        nexts: dict[str, Column] | None = None,
        maxes: dict[str, Column] | None = None,
        own: bool = True,
    ) -> OrderedGroups:
        """Add running columns: totals, last and next non-null values, maxima.

        ``own=False`` leaves the row itself out of every frame. An empty total is 0.
        """
        self = self._settled()
        sums, lasts, nexts, maxes = sums or {}, lasts or {}, nexts or {}, maxes or {}
        # a frame that ends at UNBOUNDED FOLLOWING is computed anew for every row,
        # so "next" is "last" in the opposite order
        to = 0 if own else -1
        back = self._window().rowsBetween(Window.unboundedPreceding, to)
        ahead = self._window(backward=True).rowsBetween(Window.unboundedPreceding, to)
        local = {n: F.sum(c).over(back) for n, c in sums.items()}
        local |= {n: F.last(c, ignorenulls=True).over(back) for n, c in lasts.items()}
        local |= {n: F.last(c, ignorenulls=True).over(ahead) for n, c in nexts.items()}
        local |= {n: F.max(c).over(back) for n, c in maxes.items()}
        zero = F.lit(0)
        if not self.split:
            local |= {n: F.coalesce(local[n], zero) for n in sums}
            return self._with(self.df.withColumns(local))

        here = F.struct(*self.order, _MARK)
        carry = self._summary(
            {f"_c_{n}": F.sum(c) for n, c in sums.items()}
            | {f"_c_{n}": F.max_by(c, F.when(c.isNotNull(), here)) for n, c in lasts.items()}
            | {f"_c_{n}": F.min_by(c, F.when(c.isNotNull(), here)) for n, c in nexts.items()}
            | {f"_c_{n}": F.max(c) for n, c in maxes.items()}
        )
        prior = self._block_window().rowsBetween(Window.unboundedPreceding, -1)
        later = self._block_window(backward=True).rowsBetween(Window.unboundedPreceding, -1)
        carry = carry.withColumns(
            {f"_c_{n}": F.sum(f"_c_{n}").over(prior) for n in sums}
            | {f"_c_{n}": F.last(f"_c_{n}", ignorenulls=True).over(prior) for n in lasts}
            | {f"_c_{n}": F.last(f"_c_{n}", ignorenulls=True).over(later) for n in nexts}
            | {f"_c_{n}": F.max(f"_c_{n}").over(prior) for n in maxes}
        )
        carried = [f"_c_{n}" for n in (*sums, *lasts, *nexts, *maxes)]
        df = join_same(self.df.withColumns(local), stage(carry, "carry"), self.keys + [BLOCK], "left")
        merged = {n: F.coalesce(F.col(n), zero) + F.coalesce(F.col(f"_c_{n}"), zero) for n in sums}
        merged |= {n: F.coalesce(F.col(n), F.col(f"_c_{n}")) for n in (*lasts, *nexts)}
        merged |= {n: F.greatest(F.col(n), F.col(f"_c_{n}")) for n in maxes}
        return self._with(df.withColumns(merged).drop(*carried))

    def numbered(self, name: str) -> OrderedGroups:
        """Add the 1-based row number inside the group."""
        done = self.running(sums={name: F.lit(1).cast("long")})
        return done._with(done.df.withColumn(name, F.col(name).cast("int")))

    def ranked(self, rank: str, size: str) -> OrderedGroups:
        """Add the rank by the first of ``order`` (equal values share the mean of theirs) and how many rows share the value.

        Peers may lie in several blocks: where a value begins, where the next one does and where the group ends are carried
        over. Rows without a value have neither. Equal rows are told apart here, so ``order`` need not be unique.
        """
        v = F.col(self.order[0])
        # both directions of a window must see equal rows in one order
        g = self._with(self.df.withColumn("_row", F.monotonically_increasing_id()))
        g.order = [*self.order, "_row"]
        g = g.frames({"_before": lambda w: F.lag(v).over(w), "_after": lambda w: F.lead(F.lit(1)).over(w)}, before=1, after=1)
        g = g.running(sums={"_at": v.isNotNull().cast("long")})
        begins = F.when(v.isNotNull() & ~F.coalesce(v == F.col("_before"), F.lit(False)), F.col("_at"))
        g = g.running(lasts={"_first": begins}, nexts={"_all": F.when(F.col("_after").isNull(), F.col("_at"))})
        g = g.running(nexts={"_beyond": begins}, own=False)
        n = F.coalesce(F.col("_beyond"), F.col("_all") + 1) - F.col("_first")
        g = g.add({size: F.when(v.isNotNull(), n)})
        g = g.add({rank: F.when(v.isNotNull(), F.col("_first") + (F.col(size) - 1) / 2)})
        g = g._with(g.df.drop("_before", "_after", "_at", "_first", "_all", "_beyond", "_row"))
        g.order = self.order
        return g

    def regroup(self, keys: list[str], order: list[str]) -> OrderedGroups:
        """The same rows in other groups.

        Groups of more keys are no larger than these, so when nothing was cut
        here they need no look at the data.
        """
        if self.split or not set(self.keys) <= set(keys):
            return OrderedGroups(self.result(), keys, order, self.policy)
        other = self._with(self.df)
        other.keys, other.order = list(keys), list(order)
        return other

    def add(self, columns: dict[str, Column]) -> OrderedGroups:
        return self._with(self.df.withColumns(columns))

    def result(self) -> DataFrame:
        return self.df.drop(BLOCK, _BLOCKS, _MARK) if self.split else self.df


def with_group_stats(
    df: DataFrame, keys: list[str], aggs: dict[str, Column], few: bool = True
) -> DataFrame:
    """Whole-group aggregates on every row, by partial aggregation and a join back.

    Unlike an unbounded window this never gathers a group in one task: the
    aggregate combines before its shuffle. Where ``few`` groups are expected
    the statistics are staged, so that the planner knows their size; otherwise
    AQE splits the rows of a large key. Rows with a null key get null statistics.
    """
    columns = [c.alias(n) for n, c in aggs.items()]
    if not keys:
        stats = df.agg(F.struct(*columns).alias("_stats"))
        done = df.withColumn("_stats", stats.scalar())
        return done.withColumns({n: F.col(f"_stats.{n}") for n in aggs}).drop("_stats")
    stats = df.groupBy(*keys).agg(*columns)
    return join_small(df, stats, keys) if few else df.join(stats, keys, "left")
