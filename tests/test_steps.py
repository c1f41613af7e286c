"""Stretches of the grid against its points."""

import random

import pytest
from pyspark.sql import functions as F

from stintlake.functions import steps
from stintlake.functions.asof import Samples
from stintlake.operators import telemetry as TE

RACE = "2024 AS Year, 'G' AS GranPrix"


def _race(spark, seed, cars=6, laps=9):
    """Uneven laps, shared and missing places, repeated and missing times; a car without telemetry, one without laps."""
    chance = random.Random(seed)
    lap_rows, drive_rows = [], []
    for c in range(cars):
        t = chance.choice([0.0, 0.25, 3.0])
        for n in range(laps):
            end = t + chance.choice([10.0, 10.25, 12.5, 11.3])
            lap_rows.append((f"D{c}", n + 1, chance.choice([1, 2, 3, 3, 4, None]), chance.choice(["S", None]), chance.choice([t, None]), chance.choice([end, end, None])))
            t = end
        for i in range(0 if c == 0 else 40):
            drive_rows.append((f"D{c}", c * 1000 + i, round(chance.uniform(-3, 120) * 4) / 4, float(i), float(chance.randint(0, 900))))
    drive_rows += [("D99", 1, 5.0, 1.0, 1.0), ("D1", 5000, None, 1.0, 1.0)]
    weather = [(i, chance.choice([None, i * 7.25, i * 7.25]), float(i), 20.0, chance.choice([True, False, None])) for i in range(14)] + [(99, 101.3, 1.0, None, True)]
    extra = {"Year": F.lit(2024), "GranPrix": F.lit("G")}
    return (
        spark.createDataFrame(lap_rows, "Driver string, LapNumber int, Position int, Compound string, LapStartTime double, Time double").withColumns(extra),
        spark.createDataFrame(drive_rows, "Driver string, event_id long, Time double, Speed double, Distance double").withColumns(extra),
        spark.createDataFrame(weather, "event_id long, Time double, TrackTemp double, AirTemp double, Rainfall boolean").withColumns(extra),
    )


def _same(a, b):
    b = b.select(*a.columns)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


@pytest.mark.parametrize("seed, step, cut", [(1, 0.5, False), (2, 0.7, False), (3, 0.5, True)])
def test_stretches_are_the_grid(request, spark, seed, step, cut):
    if cut:
        request.getfixturevalue("tight")
    race = _race(spark, seed)
    stretches = TE.grid_stretches(*race, step, tie="event_id")
    _same(TE.grid_view(*race, step, tie="event_id"), TE.stretch_view(stretches, step))
    assert stretches.count() * 2 < stretches.agg(F.sum(F.col("until") - F.col("from"))).first()[0]


@pytest.mark.parametrize("seed, first_lap, cut", [(4, False, False), (5, True, False), (6, False, True), (7, False, False)])
def test_gap_stretches_are_the_gaps_of_the_points(request, spark, seed, first_lap, cut):
    if cut:
        request.getfixturevalue("tight")
    race = _race(spark, seed)
    view = TE.grid_view(*race, 0.5, tie="event_id")
    if first_lap:
        view = TE.with_first_place(view.drop("Position"), race[0], "Position")
    cols = ["Driver", "t", "Position", "GapAhead", "GapBehind"]
    got = steps.points(TE.gap_stretches(*race, 0.5, tie="event_id", first_lap=first_lap), 0.5)
    _same(TE.gap_metres(view).select(*cols), got.withColumnRenamed("place", "Position").select(*cols))


def test_a_week_of_half_seconds_is_a_few_rows(spark):
    laps = spark.sql(f"SELECT {RACE}, 'A' AS Driver, int(id) AS LapNumber, int(id) AS Position, 'S' AS Compound, id * 1e4 AS LapStartTime, id * 1e4 + 1e4 AS Time FROM range(60)")
    drive = spark.sql(f"SELECT {RACE}, 'A' AS Driver, id AS event_id, id * 6e3 AS Time, double(id) AS Speed, double(id) AS Distance FROM range(101)")
    sky = spark.sql(f"SELECT {RACE}, id AS event_id, id * 6048D AS Time, 1D AS TrackTemp, 2D AS AirTemp, false AS Rainfall FROM range(101)")
    found = TE.grid_stretches(laps, drive, sky, 0.5, tie="event_id")
    assert tuple(found.agg(F.sum(F.col("until") - F.col("from")), F.count("*") < 400).first()) == (1209601, True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2 and plan.count(" Sort ") <= 4
    made = steps.points(found.select("from", "until"), 0.5)
    assert tuple(made.agg(F.count("*"), F.countDistinct("t"), F.max("t")).first()) == (1209601, 1209601, 604800.0)


def test_overlaps_by_bins_against_all_pairs(spark):
    chance = random.Random(9)

    def draw(n):
        return [(chance.choice("ab"), i, a, a + chance.randint(1, 40)) for i in range(n) for a in [chance.randint(0, 60)]]

    left, right = draw(50), draw(40)
    a = spark.createDataFrame(left, "k string, l int, from long, until long")
    b = spark.createDataFrame(right, "k string, r int, from long, until long")
    want = sorted((i, j, max(f, g), min(u, v)) for k, i, f, u in left for m, j, g, v in right if k == m and max(f, g) < min(u, v))
    for width in (1, 7, 1000):
        assert sorted(tuple(r) for r in steps.overlaps(a, b, ["k"], width).select("l", "r", "from", "until").collect()) == want


def test_step_tables_laid_over_each_other(spark):
    base = spark.createDataFrame([("x", 9), ("y", 1)], "k string, last int")
    a = spark.createDataFrame([("x", 2, 5, 1), ("x", 5, 7, 2), ("z", 0, 9, 3)], "k string, from long, until long, v int")
    b = spark.createDataFrame([("x", 0, 3, "p"), ("x", 6, 50, "q")], "k string, from long, until long, w string")
    got = sorted(tuple(r) for r in steps.merged(base, ["k"], {"v": (a, "v"), "w": (b, "w")}).collect())
    assert got == [("x", 0, 2, None, "p"), ("x", 2, 3, 1, "p"), ("x", 3, 5, 1, None), ("x", 5, 6, 2, None), ("x", 6, 7, 2, "q"), ("x", 7, 10, None, "q"), ("y", 0, 2, None, None)]


def test_nearest_of_no_samples(spark):
    base = spark.createDataFrame([("x", 3)], "k string, last int")
    none = spark.createDataFrame([], "k string, s double, v int")
    assert [tuple(r) for r in steps.nearest_steps(base, ["k"], {"n": Samples(none, "s", ["v"])}, 0.5).collect()] == [("x", 0, 4, None)]
