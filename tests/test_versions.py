"""Races in versions, summaries that add up, sessions, names that contain one another."""

import random

import pytest
from pyspark.sql import functions as F

from stintlake.operators import circuits as CI
from stintlake.operators import summaries as SU
from stintlake.sources import incremental as I
from stintlake.streaming import ingest


def _race(spark, year, rnd, laps, extra=0.0):
    rows = spark.range(1, laps + 1).select(F.lit(year).alias("Year"), F.lit(rnd).alias("RoundNumber"), F.lit("G").alias("GranPrix"))
    return rows.withColumns({"LapNumber": F.monotonically_increasing_id(), "LapTime": F.lit(90.0 + extra)})


def _seen(spark, target):
    return {tuple(r) for r in spark.read.parquet(target).groupBy("Year", "RoundNumber").agg(F.count("*"), F.sum("LapTime")).collect()}


def test_a_corrected_race_has_one_version(spark, tmp_path):
    target, manifest = f"{tmp_path}/t", f"{tmp_path}/m"
    I.land_races(_race(spark, 2023, 1, 5).unionByName(_race(spark, 2023, 2, 7)), target, manifest)
    again = _race(spark, 2023, 2, 6, 1.0)
    assert I.changed(again, I.read_landed(spark, manifest)).count() == 1
    I.overwrite_races(again, target)  # lost before the manifest
    for _ in range(2):  # and run again, twice
        I.land_changed(again, target, manifest)
        assert _seen(spark, target) == {(2023, 1, 5, 450.0), (2023, 2, 6, 546.0)}
        assert {(r.RoundNumber, r.n_rows) for r in I.read_landed(spark, manifest).collect()} == {(1, 5), (2, 6)}
        assert I.changed(again, I.read_landed(spark, manifest)).count() == 0
    # a row more or less, a row twice, another value: each is a change
    for other in (again.unionByName(again.limit(1)), again.limit(5), again.withColumn("LapTime", F.lit(1.0))):
        assert I.changed(other, I.read_landed(spark, manifest)).count() == 1


def test_stream_replaces_races(spark, tmp_path):
    paths = [f"{tmp_path}/{n}" for n in ("in", "t", "m", "c")]
    schema = _race(spark, 2023, 1, 1).schema

    def run():
        ingest.ingest_corrected(spark, paths[0], schema, *paths[1:]).awaitTermination()
        return _seen(spark, paths[1])

    _race(spark, 2023, 1, 5).coalesce(1).write.mode("append").parquet(paths[0])
    _race(spark, 2023, 2, 7).coalesce(1).write.mode("append").parquet(paths[0])
    assert run() == {(2023, 1, 5, 450.0), (2023, 2, 7, 630.0)}
    # two versions in one batch: the later file
    _race(spark, 2023, 2, 3, 2.0).coalesce(1).write.mode("append").parquet(paths[0])
    _race(spark, 2023, 2, 4, 1.0).coalesce(1).write.mode("append").parquet(paths[0])
    assert run() == {(2023, 1, 5, 450.0), (2023, 2, 4, 364.0)} == run()


def test_merged_summaries_are_those_of_all_files(spark, tmp_path):
    chance = random.Random(1)
    rows = [(f"f{i % 13}", 2018 + i % 7, f"E{i % 90}", str(chance.randint(0, 3000)) if i % 50 else None, i % 60, None if i % 9 == 0 else 1.0) for i in range(6000)]
    df = spark.createDataFrame(rows, "file string, Year int, GranPrix string, DriverID string, LapNumber int, LapTime double")
    rules = {"start": F.col("LapNumber") <= 1}
    for run, part in enumerate(("file < 'f3'", "file >= 'f3'", "file = 'f5'")):  # f5 twice
        SU.store(SU.file_summaries(df.where(part), bad=rules, run=run, most=20), f"{tmp_path}/s")
    got = SU.merged(SU.stored(spark, f"{tmp_path}/s"), most=20).first()
    whole = SU.merged(SU.file_summaries(df, bad=rules, most=20), most=20).first()
    assert got == whole
    assert (got.files, got.rows, got.missing_values) == (13, 6000, sum(v is None for r in rows for v in r))
    assert got.bad_start == sum(r[4] <= 1 for r in rows) and got.set_Year == list(range(2018, 2025)) and not got.more_Year
    assert got.set_GranPrix == sorted({r[2] for r in rows})[:20] and got.more_GranPrix
    exact = len({r[3] for r in rows} - {None})
    assert abs(got.DriverID - exact) <= 4 * SU.relative_error() * exact
    assert abs(got.Year_GranPrix - len({(r[1], r[2]) for r in rows})) <= 4 * SU.relative_error() * 630
    each = SU.file_summaries(df, most=20).select("file", F.size("set_GranPrix").alias("n"), "more_GranPrix").collect()
    assert all(r.n <= 20 for r in each)


@pytest.mark.parametrize("seed", [1, 2])
def test_containing_against_all_pairs(spark, seed):
    chance = random.Random(seed)
    name = lambda n: "".join(chance.choice("abé ") for _ in range(chance.randint(0, n)))
    parts, wholes = [name(5) for _ in range(60)] + ["", None], [name(9) for _ in range(50)] + ["", None, "aaaa"]
    a = spark.createDataFrame(list(enumerate(parts)), "i int, p string")
    b = spark.createDataFrame(list(enumerate(wholes)), "j int, w string")
    want = sorted((i, j) for i, p in enumerate(parts) for j, w in enumerate(wholes) if p is not None and w is not None and p in w)
    assert sorted((r.i, r.j) for r in CI.containing(a, b, "p", "w").collect()) == want


def test_a_long_name_costs_its_length(spark):
    long = "x" * 3000 + "Monza" + "yz" * 3500
    laps = spark.createDataFrame([(long,), ("Monza",)], "Location string")
    circuits = spark.createDataFrame([("Monza", 5793, 0)], "Location string, length_m int, file_order int")
    assert {r.length_m for r in CI.join_circuit(laps, circuits).collect()} == {5793}
    grams = spark.createDataFrame([(long,)], "w string").select(F.size(F.flatten(F.array(*[CI.grams("w", n) for n in range(4)]))).alias("n"))
    assert grams.first().n < 10_000
