"""What keeps the work of a query in proportion to its input."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stintlake.functions import asof, ordered, quantiles, steps
from stintlake.operators import mldata as M
from stintlake.operators import telemetry as TE


def test_spans_are_sorted_without_the_totals_of_the_samples(spark, monkeypatch):
    """Samples with six measures came as structs of their totals to every edge of every span."""
    seen = []

    class Watched(asof.OrderedGroups):
        def __init__(self, df, *args, **kwargs):
            seen.append(df.schema)
            super().__init__(df, *args, **kwargs)

    monkeypatch.setattr(asof, "OrderedGroups", Watched)
    spans = spark.createDataFrame([(1, 1, 0.0, 2.0), (1, 2, 2.0, 3.5), (1, 3, 9.0, 9.5), (2, 1, 0.0, 1.0)], "race int, lap int, s double, e double")
    rows = [(1, 1.0, 10.0, 1), (1, 2.0, 20.0, 2), (1, 2.0, 60.0, 3), (1, 3.0, None, 4)]
    samples = spark.createDataFrame(rows, "race int, t double, temp double, tie int").withColumn("wet", F.col("tie") == 3)
    found = asof.interval_stats(spans, samples, ["race"], ["lap"], "s", "e", "t", ["temp"], ["wet"], ["temp"], "tie")
    got = {(r.race, r.lap): r for r in found.collect()}
    assert [(k, r.n, r.temp_mean, r.wet_any, r.temp_last) for k, r in sorted(got.items())] == [
        ((1, 1), 3, 30.0, True, 60.0), ((1, 2), 3, 40.0, True, None), ((1, 3), 0, None, None, None), ((2, 1), 0, None, None, None)
    ]
    assert (got[1, 1].before, got[1, 1].after.temp) == (None, 10.0)
    assert (got[1, 2].before.temp, got[1, 2].after.temp) == (10.0, 20.0)
    assert (got[1, 3].before.sample_time, got[1, 3].after) == (3.0, None)
    assert (got[2, 1].before, got[2, 1].after) == (None, None)
    with_spans = [s for s in seen if "lap" in s.names]
    assert with_spans and not any(isinstance(f.dataType, T.StructType) for s in with_spans for f in s.fields)


def test_races_that_share_a_task_are_cut_before_they_fill_it(spark, monkeypatch):
    """Each of a few races had all bytes of a task to itself, though several of them come to one task."""
    cut = []

    class Watched(asof.OrderedGroups):
        def __init__(self, *args, **kwargs):
            super().__init__(*args, **kwargs)
            cut.append(self.split)

    monkeypatch.setattr(asof, "OrderedGroups", Watched)
    samples = spark.sql("SELECT id % 3 AS race, double(id div 3) AS t, double(id % 10) AS temp, id AS tie, id % 50 = 0 AS wet FROM range(300)")
    spans = spark.sql("SELECT id % 3 AS race, id AS lap, double(id div 3) AS s, id div 3 + 2.5D AS e FROM range(300)")

    def found(max_bytes):
        cut.clear()
        policy = ordered.SplitPolicy(sample_every=1, max_bytes=max_bytes)
        stats = asof.interval_stats(spans, samples, ["race"], ["lap"], "s", "e", "t", ["temp"], ["wet"], ["temp"], "tie", policy)
        return sorted(map(str, stats.collect())), list(cut)

    whole, none_cut = found(1 << 30)
    assert none_cut == [False, False] and len(whole) == 300
    # 100 samples of 112 bytes and 300 rows of 32 bytes a race
    assert found(16_000) == (whole, [True, True])


def test_wide_rows_make_smaller_blocks(spark):
    policy = ordered.SplitPolicy(max_rows=1000, max_bytes=80_000)
    narrow = spark.range(1)
    wide = spark.range(1).select(*[F.lit(1.0).alias(f"c{i}") for i in range(100)])
    assert policy.rows(narrow) == 1000
    assert policy.rows(wide) < 100


def test_quantiles_read_the_table_twice(spark):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    plain = spark.range(1000).select(F.col("id").cast("double").alias("a"), (F.col("id") % 7).alias("b"), F.lit(None).cast("double").alias("c"))
    df = plain.mapInArrow(count, plain.schema)
    got = {r.column: (r.q0, r.q1) for r in quantiles.column_quantiles(df, ["a", "b", "c"], [0.25, 0.5]).collect()}
    assert got == {"a": (249.75, 499.5), "b": (1.0, 3.0), "c": (None, None)}
    assert read.value == 2000


def test_one_hot_rows_do_not_grow_with_the_values(spark):
    codes = spark.range(1000).select(F.concat(F.lit("D"), F.col("id").cast("string")).alias("value"), F.col("id").cast("int").alias("code"))
    codes = codes.unionByName(spark.createDataFrame([(M.OTHER, 1000)], "value string, code int"))
    rows = spark.createDataFrame([("D7",), ("unseen",), (None,)], "Driver string")
    got = {r.Driver: r for r in M.label_encode_other(rows, "Driver", codes, "code").collect()}
    assert {k: (r.code, r.code_onehot.size, r.code_onehot.indices, r.code_onehot["values"]) for k, r in got.items()} == {
        "D7": (7, 1001, [7], [1]), "unseen": (1000, 1001, [1000], [1]), None: (1000, 1001, [1000], [1])
    }


def _race(spark, cars):
    at = datetime.datetime(2024, 1, 1)
    laps = [(2020, "A", f"D{c}", n, "SOFT", c, 10.0 * n + c, 10.0 * (n - 1) + c) for c in range(cars) for n in (1, 2, 3)]
    drive = [(2020, "A", f"D{c}", c * 100 + i, 3.1 * i + c, 80.0 + i, 5.0 * i, at) for c in range(cars) for i in range(9)]
    sky = [(2020, "A", i, 1.7 * i, None if i == 4 else i / 3, float("nan") if i == 15 else i / 7, i % 3 == 0) for i in range(20)]
    laps = spark.createDataFrame(laps, "Year int, GranPrix string, Driver string, LapNumber int, Compound string, Position int, Time double, LapStartTime double")
    drive = spark.createDataFrame(drive, "Year int, GranPrix string, Driver string, event_id int, Time double, Speed double, Distance double, Date timestamp")
    sky = spark.createDataFrame(sky, "Year int, GranPrix string, event_id int, Time double, TrackTemp double, AirTemp double, Rainfall boolean")
    return laps, drive, sky


def test_sums_of_the_grid_are_those_of_its_stretches(spark, monkeypatch):
    race = _race(spark, 3)
    rows = [r.asDict() for r in TE.grid_stretches(*race, 0.5, tie="event_id").collect()]
    want = {}
    for r in rows:
        mine = want.setdefault((r["Driver"], r["LapNumber"], r["Compound"], r["Position"]), {"n": 0, "rain": 0, "TrackTemp": [], "AirTemp": [], "Speed": []})
        n = r["until"] - r["from"]
        mine["n"] += n
        mine["rain"] += n * r["Rain"]
        for c in ("TrackTemp", "AirTemp", "Speed"):
            mine[c] += [r[c]] * n if r[c] is not None else []


    sizes = []
    plain = steps.nearest_steps
    monkeypatch.setattr(steps, "nearest_steps", lambda base, keys, samples, *a, **k: sizes.append((tuple(keys), tuple(samples))) or plain(base, keys, samples, *a, **k))
    got = {(r.Driver, r.LapNumber, r.Compound, r.Position): r for r in TE.grid_sums(*race, 0.5, tie="event_id").collect()}
    assert got.keys() == want.keys()
    for k, w in want.items():
        r = got[k]
        assert (r.points, r.rain_points) == (w["n"], w["rain"])
        for c in ("TrackTemp", "AirTemp", "Speed"):
            mean = sum(w[c]) / len(w[c]) if w[c] else None
            assert getattr(r, c) == (pytest.approx(mean, abs=1e-12, nan_ok=True) if w[c] else None)
    assert all("Driver" not in keys for keys, names in sizes if "weather" in names)
