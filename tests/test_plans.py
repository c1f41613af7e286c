"""The learning-data plan from the race table to sequences."""

import os

from pyspark.sql import functions as F

import __spark_entry__ as entry
from stintlake.catalog.roles import role
from stintlake.plans import lap_dataset
from stintlake.session import stage, staged_run, staging_dir


def test_prepare_keeps_rows_and_makes_full_sequences(spark):
    entry.queries()
    rows = lap_dataset.features(lap_dataset.dataset(role(spark, "/root/testdata/sf0.001", "race_laps")))
    prepared = lap_dataset.prepare(rows)
    assert prepared.rows.count() == rows.where("Year <> 2022").count()
    laps = prepared.rows.groupBy("DriverRaceID").count()
    wanted = laps.select(F.sum(F.greatest(F.col("count") - 9, F.lit(0)))).first()[0]
    sequences = prepared.sequences()
    assert sequences.count() == wanted
    assert sequences.where((F.size("X") != 10) | (F.size(F.col("X")[0]) != len(prepared.features))).count() == 0
    train = prepared.rows.where("split = 'train'")
    centre = train.agg(F.percentile("LapTime", 0.5), F.percentile("AirTemp", 0.5)).first()
    assert all(abs(c) < 1e-9 for c in centre)


def test_a_run_removes_what_it_staged(spark):
    with staged_run(spark) as folder:
        assert stage(spark.range(5)).count() == 5
        assert os.listdir(folder.removeprefix("file:"))
    assert not os.path.exists(folder.removeprefix("file:"))
    assert not staging_dir(spark).endswith(os.path.basename(folder))
