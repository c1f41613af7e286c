"""Cut groups must give what the plain window gives."""

import pytest
from pyspark.sql import functions as F

from stintlake.functions import ordered
from stintlake.functions.ordered import OrderedGroups, SplitPolicy, with_group_stats
from stintlake.operators.neighbours import sector_neighbours

PLAIN = SplitPolicy(max_rows=10**9)


def _rows(spark):
    # one group of 300 rows among groups of 1..9 rows, with a null key
    df = spark.range(400).select(
        F.when(F.col("id") < 300, F.lit("hot"))
        .when(F.col("id") < 310, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 12).cast("string")))
        .alias("k"),
        (F.col("id") * 7919 % 401).cast("int").alias("t"),
        F.when(F.col("id") % 5 == 0, (F.col("id") * 13 % 17).cast("double")).alias("v"),
    )
    return df


def _add(df, keys, policy):
    g = OrderedGroups(df, keys, ["t"], policy)
    g = g.frames(
        {
            "prev2": lambda w: F.lag("t", 2).over(w),
            "next1": lambda w: F.lead("t", 1).over(w),
            "roll": lambda w: F.count("v").over(w.rowsBetween(-9, 0)),
        },
        before=9,
        after=1,
    )
    g = g.running(
        sums={"total": F.col("t")},
        lasts={"last_v": F.when(F.col("v").isNotNull(), F.struct("v", "t"))},
        nexts={"next_v": F.col("v")},
        maxes={"top": F.col("v")},
    )
    g = g.running(sums={"others": F.col("v")}, lasts={"prev_v": F.col("v")}, own=False)
    return g.numbered("rn")


@pytest.mark.parametrize("keys, max_rows", [(["k"], 4), (["k"], 100), ([], 25)])
def test_cut_equals_plain(spark, keys, max_rows):
    df = _rows(spark)
    cut = _add(df, keys, SplitPolicy(max_rows=max_rows, sample_every=1))
    assert cut.split
    plain = _add(df, keys, PLAIN)
    assert not plain.split
    a, b = cut.result(), plain.result()
    assert a.columns == b.columns
    assert a.count() == 400
    assert a.exceptAll(b).count() == 0


def test_many_blocks_use_two_levels(spark):
    df = spark.range(2000).select(F.col("id").cast("int").alias("t"))
    g = OrderedGroups(df, [], ["t"], SplitPolicy(max_rows=5, sample_every=1))
    assert g.df.select("_block").distinct().count() > 200
    assert g.numbered("rn").result().where("rn <> t + 1").count() == 0


def test_no_hot_group_means_plain_window(spark):
    g = OrderedGroups(_rows(spark), ["k"], ["t"])
    assert not g.split
    plan = g.numbered("rn").result()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_group_stats(spark):
    df = _rows(spark)
    one = with_group_stats(df, ["k"], {"n": F.count("*")})
    assert one.where("k = 'hot' and n <> 300").count() == 0
    assert one.where("k is null and n is not null").count() == 0
    every = with_group_stats(df, [], {"n": F.count("*"), "m": F.max("t")})
    assert every.where("n <> 400").count() == 0


def test_groups_looked_at_once(spark, monkeypatch):
    looks = []
    monkeypatch.setattr(ordered, "_oversized", lambda df, keys, policy: looks.append(tuple(keys)) or False)
    df = _rows(spark)
    with ordered.looked_at(df, ["k"]):
        OrderedGroups(df.where("t > 3"), ["k"], ["t"])
        OrderedGroups(df, ["k", "v"], ["t"])
        OrderedGroups(df, ["v"], ["t"])
    OrderedGroups(df, ["k"], ["t"])
    assert looks == [("k",), ("v",), ("k",)]


@pytest.mark.parametrize("max_rows", [6, 40, 10**9])
def test_ranks_and_peers_across_blocks(spark, max_rows):
    # many equal values, equal rows among them, missing values, groups of one
    df = spark.range(300).select((F.col("id") % 3).alias("k"), F.when(F.col("id") % 7 != 0, (F.col("id") * 13 % 10).cast("double")).alias("v"))
    df = df.unionByName(spark.createDataFrame([(9, 1.0), (8, None)], "k long, v double"))
    got = OrderedGroups(df, ["k"], ["v"], SplitPolicy(max_rows=max_rows, sample_every=1)).ranked("r", "n").result()
    values = {}
    for row in df.collect():
        values.setdefault(row.k, []).append(row.v)
    want = []
    for k, vs in values.items():
        for v in vs:
            known = [x for x in vs if x is not None]
            same = known.count(v) if v is not None else None
            want.append((k, v, sum(x < v for x in known) + (same + 1) / 2 if same else None, same))
    assert sorted(map(repr, want)) == sorted(repr((r.k, r.v, r.r, r.n)) for r in got.collect())


def test_sector_neighbours_in_one_exchange(spark):
    rows = [(n, lap, s, float(n * 7 % 5)) for n in range(9) for lap in (1, 2) for s in (1, 2)]
    df = spark.createDataFrame(rows, "DriverNumber long, LapNumber int, Sector int, SectorTime double")
    df = df.withColumns({"Year": F.lit(2023), "GranPrix": F.lit("G"), "SectorSessionTime": F.lit(1.0)})
    plan = sector_neighbours(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
