"""Exact sums against fractions, and weather means next to outliers."""

import math
import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from stintlake.functions import exact
from stintlake.operators import weather as W


def test_chunks_lose_nothing(spark):
    chance = random.Random(1)
    values = [struct.unpack("<d", struct.pack("<Q", chance.getrandbits(64)))[0] for _ in range(500)]
    values += [0.0, -0.0, 2.0**32, 2.0**32 - 1, -(2.0**1023) * 1.9, 1e22, 25.5, 5e-324, float("nan"), float("inf"), None]
    cut = spark.createDataFrame([(v,) for v in values], "v double").select("v", exact.chunks("v").alias("c"))
    for r in cut.collect():
        want = Fraction(r.v) if r.v is not None and math.isfinite(r.v) else 0
        assert sum(Fraction(c) * Fraction(2) ** (32 * (r.c.k - j)) for j, c in enumerate((r.c.c0, r.c.c1, r.c.c2))) == want


def test_sums_are_those_of_fsum_and_have_few_bands(spark):
    chance = random.Random(2)
    values = [chance.gauss(20, 5) for _ in range(999)] + [-chance.random() * 1e-3]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = exact.bands(df, ["v"])["v"]
    assert len(found) <= 4
    sums = df.select(exact.chunks("v").alias("c")).agg(*[F.sum(exact.part(F.col("c"), b)).alias(f"s{b}") for b in found])
    got = sums.select(exact.total({b: F.col(f"s{b}") for b in found})).first()[0]
    assert got == pytest.approx(math.fsum(values), rel=1e-15)
    assert exact.bands(df.where("v is null"), ["v"]) == {"v": []}


@pytest.mark.parametrize("cut", [False, True])
def test_outliers_change_no_other_mean(request, spark, cut):
    if cut:
        request.getfixturevalue("tight")
    chance = random.Random(3)
    samples = [(float(t), chance.gauss(25, 3)) for t in range(300)]
    laps = spark.sql("SELECT 2023 AS Year, 'G' AS GranPrix, 1 AS DriverNumber, int(id) AS LapNumber, id * 20D AS LapStartTime, id * 20D + 15 AS Time FROM range(14)")

    def means(extra):
        rows = spark.createDataFrame(samples + extra, "Time double, AirTemp double")
        others = {c: F.lit(1.0) for c in ("Humidity", "TrackTemp", "Pressure", "WindSpeed", "WindDirection")}
        rows = rows.withColumns({"Year": F.lit(2023), "GranPrix": F.lit("G"), "Rainfall": F.lit(False), **others})
        return {r.LapNumber: r.AirTemp for r in W.join_weather_avg(laps, rows).collect()}

    plain = means([])
    for lap, mean in plain.items():
        inside = [v for t, v in samples if lap * 20 <= t <= lap * 20 + 15]
        assert mean == pytest.approx(math.fsum(inside) / len(inside), rel=1e-15)
    # all odd samples lie between two laps
    odd = [(17.5, 1e22), (37.5, -1e300), (57.5, 1e-300), (77.5, float("nan")), (97.5, float("inf")), (117.5, float("-inf"))]
    assert means(odd) == plain
    # inside a lap what is not finite counts as missing
    assert means([(5.5, float("nan")), (26.5, float("inf"))]) == plain
    assert means([(5.5, 1e22)])[0] == pytest.approx(1e22 / 17)
