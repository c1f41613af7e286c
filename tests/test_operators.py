"""Operators on small hand-written tables with the awkward rows in them."""

import pytest
from pyspark.sql import functions as F

from stintlake.functions import columns as C
from stintlake.functions.asof import Samples, align
from stintlake.functions.quantiles import column_quantiles, group_quantiles
from stintlake.operators import circuits as CI
from stintlake.operators import features as X
from stintlake.operators import laps as L
from stintlake.operators import metrics as ME
from stintlake.operators import mldata as ML
from stintlake.operators import neighbours as N
from stintlake.operators import quality as Q
from stintlake.operators import stints as S
from stintlake.operators import telemetry as TE
from stintlake.operators import weather as W

def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).orderBy(*cols).collect()]


def lap_table(spark, data, schema):
    df = spark.createDataFrame(data, schema)
    return df.withColumns({"Year": F.lit(2023), "GranPrix": F.lit("G")})


# -- weather ---------------------------------------------------------------


@pytest.fixture
def weather(spark):
    data = [
        # two samples at 10: the first by file order counts for "nearest"
        (10.0, 1, 20.0, 50.0, 30.0, 1000.0, 1.0, 10.0, False),
        (10.0, 2, 22.0, 50.0, 30.0, 1000.0, 1.0, 10.0, True),
        (20.0, 3, None, 60.0, 40.0, 1001.0, 2.0, 20.0, False),
        (40.0, 4, 30.0, 70.0, 50.0, 1002.0, 3.0, 30.0, True),
    ]
    cols = "Time double, event_id int, AirTemp double, Humidity double, TrackTemp double, Pressure double, WindSpeed double, WindDirection double, Rainfall boolean"
    return lap_table(spark, data, cols)


@pytest.fixture
def timed_laps(spark):
    data = [
        (1, 1, 10.0, 20.0),  # a sample exactly on each end
        (1, 2, 11.0, 19.0),  # none inside, 10 is nearest to the start
        (1, 3, 30.0, 31.0),  # 20 and 40 equally near: the earlier one
        (1, 4, None, 50.0),  # no start
        (1, 5, 50.0, 60.0),  # after all samples
        (1, 6, 0.0, 5.0),  # before all samples
    ]
    return lap_table(spark, data, "DriverNumber int, LapNumber int, LapStartTime double, Time double")


def _weather_values(df):
    return {r[0]: r[1:] for r in df.select("LapNumber", "AirTemp", "Humidity", "Rainfall").collect()}


@pytest.mark.parametrize("cut", [False, True])
def test_weather_average_and_nearest(request, spark, weather, timed_laps, cut):
    if cut:
        request.getfixturevalue("tight")
    got = _weather_values(W.join_weather_avg(timed_laps, weather, tie="event_id"))
    assert got[1] == (21.0, pytest.approx(160 / 3), True)
    assert got[2] == (20.0, 50.0, False)
    assert got[3] == (None, 60.0, False)
    assert got[4] == (None, None, None)
    assert got[5] == (30.0, 70.0, True)
    assert got[6][1] == 50.0


def test_weather_variants(spark, weather, timed_laps):
    no_fallback = _weather_values(W.join_weather_avg(timed_laps, weather, nearest=False, rain_unknown=False))
    assert no_fallback[2] == (None, None, False)
    last = {r.LapNumber: r for r in W.join_weather_last_over_n(timed_laps, weather, tie="event_id").collect()}
    assert last[1].Humidity == 20.0 and last[1].AirTemp is None and last[1].Rainfall == 0
    assert last[2].Humidity is None


def test_align_directions(spark):
    points = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 7.0), ("a", 3, None), ("b", 4, 1.0)], "k string, id int, t double")
    seen = spark.createDataFrame([("a", 5.0, 1), ("a", 9.0, 2)], "k string, s double, v int")
    for how, want in (
        ("backward", {1: 1, 2: 1, 3: None, 4: None}),
        ("forward", {1: 1, 2: 2, 3: None, 4: None}),
        ("nearest", {1: 1, 2: 1, 3: None, 4: None}),
    ):
        got = align(points, ["k"], "t", ["id"], {"m": Samples(seen, "s", ["v"])}, how)
        assert {r.id: r.m and r.m.v for r in got.collect()} == want


# -- neighbours ------------------------------------------------------------


def test_time_deltas_edges_and_nulls(spark):
    data = [
        (1, 1, 1, 100.0),
        (2, 1, 2, 101.0),
        (3, 1, 3, None),
        (4, 1, 4, 104.0),
        (5, 1, None, 90.0),
        (1, 2, 1, 200.0),  # alone on its lap
    ]
    laps = lap_table(spark, data, "DriverNumber int, LapNumber int, Position int, Time double")
    cols = ["TimeDeltaToDriverAhead", "TimeDeltaToDriverTwoAhead", "TimeDeltaToDriverBehind", "TimeDeltaToDriverTwoBehind"]
    got = {(r.LapNumber, r.DriverNumber): tuple(r[c] for c in cols) for r in N.time_deltas(laps).collect()}
    assert got[1, 1] == (0.0, 0.0, 1.0, None)
    assert got[1, 2] == (1.0, 0.0, None, 3.0)
    assert got[1, 3] == (None,) * 4
    assert got[1, 4] == (None, 3.0, 0.0, 0.0)
    assert got[1, 5] == (None,) * 4
    assert got[2, 1] == (0.0,) * 4
    passed = {(r.LapNumber, r.DriverNumber): tuple(r[c] for c in cols) for r in N.time_deltas(laps, drop_untimed=True).collect()}
    assert passed[1, 2] == (1.0, 0.0, 3.0, 0.0)
    assert passed[2, 1] == (None,) * 4


def test_neighbours_signed_relation(spark):
    # own - ahead on one car is behind - own on the other
    data = [(44, "HAM", 1, 1, 92.0), (4, "NOR", 1, 2, 91.5), (27, "HUL", 1, 4, 93.0)]
    laps = lap_table(spark, data, "DriverNumber int, Driver string, LapNumber int, Position int, LapTime double")
    got = {r.Driver: r for r in N.join_neighbours_exact(laps, signed=True).collect()}
    assert got["NOR"].DiffToAhead == got["HAM"].DiffToBehind == -0.5
    assert got["HAM"].DriverAhead is None and got["NOR"].DriverBehind is None
    near = {r.Driver: r for r in N.join_neighbours_nearest(laps).collect()}
    assert near["NOR"].NextDriver == "HUL" and near["HUL"].PreviousDriver == "NOR"
    assert {r.Driver: r.DiffToAhead for r in N.join_neighbours_exact(laps).collect()}["NOR"] == 0.5


def test_average_rank_shares_ties(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("a", 2.0), ("a", None), ("b", 5.0)], "k string, v double")
    assert rows(N.average_rank(df, ["k"], "v", "r"), "k", "r") == [("a", None), ("a", 1.5), ("a", 1.5), ("a", 3.0), ("b", 1.0)]


# -- stints ----------------------------------------------------------------


def test_stint_life_drop(spark):
    data = [(1, 1, 1, "SOFT", 1.0, 100), (1, 2, 1, "SOFT", 2.0, 200), (1, 3, 2, "HARD", 1.0, 100), (1, 4, 2, "HARD", 2.0, 200)]
    laps = lap_table(spark, data, "DriverNumber int, LapNumber int, Stint int, Compound string, TyreLife double, TireMeters int")
    assert rows(S.stint_life_drop(laps), "LapNumber", "Compound") == [(2, "SOFT"), (4, "HARD")]


def test_golden_distance_relations(spark):
    # metres are tyre life times the circuit's length, and are normalised by the largest
    laps = lap_table(spark, [(10, 1, 17.0, 3337), (10, 2, None, 3337), (10, 3, 0.0, None)], "DriverNumber int, LapNumber int, TyreLife double, length_m int")
    laps = laps.withColumns({"Stint": F.lit(1), "Compound": F.lit("MEDIUM")})
    done = L.meters_zero_branch(laps)
    assert rows(done, "LapNumber", "TireMeters", "Compound") == [(1, 56729, "MEDIUM"), (2, 0, None), (3, 0, None)]
    scaled = {r.LapNumber: r.NormalizedTireMeters for r in S.global_norm(done, ["TireMeters"]).collect()}
    assert scaled == {1: 1.0, 2: 0.0, 3: 0.0}


def test_strategy_with_unknown_compound_is_left_out(spark):
    plans = spark.createDataFrame(
        [(1, [("SOFT", 20), ("MEDIUM", 33)]), (2, [("SOFT", 20), ("ULTRA", 33)])], "strategy_id int, stints array<struct<compound:string,laps:int>>"
    )
    known = spark.createDataFrame([("SOFT", 80.0), ("MEDIUM", 81.0)], "Compound string, avg_lap_time double")
    assert rows(S.strategy_cost(plans, known), "strategy_id", "total_time") == [(1, 80.0 * 20 + 81.0 * 33)]
    assert rows(S.strategy_cost_default(plans, known), "strategy_id", "total_time")[1] == (2, 80.0 * 20 + 92.0 * 33)


def test_circuit_match_is_exact_first_then_first_similar(spark):
    circuits = spark.createDataFrame([("Yas Marina", 1, 0), ("Yas", 2, 1), ("Monaco", 3, 2), ("Monaco Park", 4, 3)], "Location string, length_m int, file_order int")
    laps = spark.createDataFrame([("Yas",), ("Yas Island",), ("Monaco Park",), ("Onaco",), ("onaco",), (None,)], "Location string")
    got = {r.Location: r.length_m for r in CI.join_circuit(laps, circuits).collect()}
    assert got == {"Yas": 2, "Yas Island": 2, "Monaco Park": 4, "Onaco": None, "onaco": 3, None: None}
    loose = {r.Location: r.length_m for r in CI.join_circuit(laps, circuits, ignore_case=True).collect()}
    assert loose["Onaco"] == 3


# -- features --------------------------------------------------------------


def test_target_counts_a_known_stint_after_a_missing_one(spark):
    data = [("r", 1, 1, "A"), ("r", 2, None, "A"), ("r", 3, 2, "B"), ("r", 4, 2, "B")]
    df = spark.createDataFrame(data, "DriverRaceID string, LapNumber int, Stint int, Compound string")
    got = rows(X.targets(X.by_car(df)).result(), "LapNumber", "tire_change_next_lap", "next_tire_type")
    assert got == [(1, 0, "NO_CHANGE"), (2, 1, "B"), (3, 0, "NO_CHANGE"), (4, 0, "NO_CHANGE")]


def test_interpolation_limit_and_ends(spark):
    values = [None, 1.0, None, None, None, None, 6.0, None, None]
    df = spark.createDataFrame([("r", "c", i, v) for i, v in enumerate(values)], "RaceID string, DriverRaceID string, LapNumber int, v double")
    free = [r.v for r in X.interpolate(X.by_race(df), ["v"]).result().orderBy("LapNumber").collect()]
    assert free == [None, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 6.0, 6.0]
    limited = [r.v for r in X.interpolate(X.by_race(df), ["v"], 3).result().orderBy("LapNumber").collect()]
    assert limited == [None, 1.0, 2.0, 3.0, 4.0, None, 6.0, 6.0, 6.0]


def test_sequences_need_ten_laps(spark):
    data = [("short", i, float(i)) for i in range(9)] + [("ten", i, float(i)) for i in range(10)]
    df = spark.createDataFrame(data, "DriverRaceID string, LapNumber int, f double").withColumns(
        {"tire_change_next_lap": F.lit(0), "t": F.lit(1)}
    )
    got = ML.sequences(df, ["f"], 10, "t").collect()
    assert [(r.DriverRaceID, r.LapNumber, [x[0] for x in r.X]) for r in got] == [("ten", 9, [float(i) for i in range(10)])]


def test_quantiles(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(1, 102)] + [("b", 3.0), ("c", None)], "k string, v double")
    q = {r.k: (r.lo, r.mid) for r in group_quantiles(df, ["k"], "v", {"lo": 0.255, "mid": 0.5}).collect()}
    assert q == {"a": (pytest.approx(26.5), 51.0), "b": (3.0, 3.0)}
    big = spark.range(100_000).select(((F.col("id") * 7919) % 100_003).cast("double").alias("v"))
    exact = big.agg(F.percentile("v", [0.01, 0.5, 0.99]).alias("p")).first().p
    got = column_quantiles(big, ["v"], [0.01, 0.5, 0.99]).first()
    assert [got.q0, got.q1, got.q2] == exact


@pytest.mark.parametrize("n", [1, 2, 3, 5, 482, 483, 484, 485])
def test_quantiles_of_short_columns(spark, n):
    df = spark.range(n).select(((F.col("id") * 7919) % 100_003).cast("double").alias("v"))
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    exact = df.agg(F.percentile("v", probs).alias("p")).first().p
    got = column_quantiles(df, ["v"], probs).first()
    assert [got[f"q{i}"] for i in range(len(probs))] == pytest.approx(exact)


def test_constant_column_is_only_centred(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (5.0,)], "v double")
    assert [r.v for r in ML.robust_scale(df, ["v"], ML.robust_fit(df, ["v"])).collect()] == [0.0] * 3


def test_augment_keeps_originals_and_counts(spark):
    df = spark.createDataFrame([(1, [[1.0, 2.0]]), (0, [[3.0, 4.0]])], "y_change int, X array<array<float>>")
    done = ML.augment(df, ["y_change"], factor=3, noise=0.01)
    assert done.count() == 4
    assert done.where("copy = 0").drop("copy").exceptAll(df).count() == 0
    noisy = [r.X[0] for r in done.where("copy > 0").collect()]
    assert all(0 < abs(a - b) < 0.2 for x in noisy for a, b in zip(x, (1.0, 2.0)))


def test_weighted_sample_balances_classes(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 20 == 0).cast("int").alias("y_change"))
    drawn = ML.weighted_sample(df, ["id"], ML.class_weights(df), 20_000).groupBy("y_change").count().collect()
    assert all(8_500 < r["count"] < 11_500 for r in drawn) and len(drawn) == 2


# -- metrics ---------------------------------------------------------------


def test_metrics_by_brute_force(spark):
    data = [(i * 37 % 11 / 11, int(i % 7 == 0 or i * 37 % 11 > 8)) for i in range(60)]
    df = spark.createDataFrame(data, "prob double, y int")
    pos = [p for p, y in data if y]
    neg = [p for p, y in data if not y]
    auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    assert ME.roc_auc(df).first()[0] == pytest.approx(auc)
    marks = sorted({p for p, _ in data}, reverse=True)
    ap, before = 0.0, 0.0
    for m in marks:
        tp = sum(p >= m for p in pos)
        recall = tp / len(pos)
        ap += (recall - before) * tp / (tp + sum(n >= m for n in neg))
        before = recall
    assert ME.pr_auc(df).first()[0] == pytest.approx(ap)


def test_areas_of_one_class_are_zero(spark):
    df = spark.createDataFrame([(0.2, 1), (0.7, 1)], "prob double, y int")
    assert ME.roc_auc(df).first()[0] == 0.0 and ME.pr_auc(df).first()[0] == 0.0


def test_sweep_on_an_uneven_grid(spark):
    df = spark.createDataFrame([(0.1, 0), (0.3, 1), (0.9, 1)], "prob double, y int")
    got = rows(ME.threshold_sweep(df, [0.05, 0.3, 0.95]), "threshold", "tp", "fp")
    assert got == [(0.05, 2, 1), (0.3, 2, 0), (0.95, 0, 0)]


# -- columns and quality ---------------------------------------------------


def test_intervals_and_names(spark):
    df = spark.createDataFrame(
        [("0 days 00:01:29.108000", "São Paulo Grand-Prix!"), ("92.011", "???"), ("NaT", ""), (None, None)], "t string, n string"
    )
    got = df.select(C.seconds_or_interval("t").alias("s"), C.sanitize_event("n").alias("n")).collect()
    assert [r.s for r in got] == [pytest.approx(89.108), 92.011, None, None]
    assert [r.n for r in got] == ["São_Paulo_Grand-Prix", "unknown_event", "unknown_event", "unknown_event"]


def test_validate_lists_issues(spark):
    df = spark.createDataFrame(
        [("f", 2023, "1", 1, 0), ("f", 2023, "1", 1, 2), ("f", 2023, "2", 0, 1)], "file string, Year int, DriverID string, LapNumber int, Position int"
    )
    got = Q.validate(df).first()
    assert got.issues == ["missing columns: LapTime", "LapNumber <= 0", "Position <= 0", "1 repeated key groups"]
    assert (got.n_rows, got.n_drivers, got.years) == (3, 2, [2023])


def test_mode_fill_takes_the_smallest_of_several(spark):
    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", None), ("b", None)], "k string, c string")
    assert rows(X.fill_mode(df, ["k"], ["c"]), "k", "c") == [("a", "x"), ("a", "x"), ("a", "y"), ("b", "Unknown")]


def test_grid_of_half_seconds_over_a_race(spark):
    """Every sample of a race of two hours is the nearest one to some point, and a race of a week is made in short runs."""
    race = "2024 AS Year, 'G' AS GranPrix"
    laps = spark.sql(f"""SELECT {race}, 'A' AS Driver, int(id + 1) AS LapNumber, int(id % 20 + 1) AS Position, 'SOFT' AS Compound,
        id * 90D AS LapStartTime, (id + 1) * 90D AS Time FROM range(80)""")
    telemetry = spark.sql(f"SELECT {race}, 'A' AS Driver, id AS event_id, id * 0.5D AS Time, double(id) AS Speed, double(id) AS Distance FROM range(14401)")
    weather = spark.sql(f"SELECT {race}, id AS event_id, id * 60D AS Time, double(id) AS TrackTemp, 20D AS AirTemp, id % 2 = 0 AS Rainfall FROM range(121)")
    seen = TE.grid_view(laps, telemetry, weather, tie="event_id")
    found = seen.agg(F.count("*").alias("n"), F.countDistinct("Speed").alias("t"), F.countDistinct("LapNumber").alias("l"), F.countDistinct("TrackTemp").alias("w"))
    assert tuple(found.first()) == (14401, 14401, 80, 121)
    assert seen.where("Speed <> 2 * t").count() == 0
    week = spark.sql(f"SELECT {race}, 7 * 86400D AS end")
    grid = TE.time_grid(laps, week)
    assert tuple(grid.agg(F.count("*"), F.countDistinct("t"), F.max("t")).first()) == (1209601, 1209601, 604800.0)
    plan = grid._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 2
