"""Sources, sinks and streaming ingestion in fresh folders."""

import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stintlake.schemas import STINT_LIVES
from stintlake.sources import readers as R
from stintlake.sources import sinks as W
from stintlake.sources.folder_csv import write_folder_csv
from stintlake.sources.incremental import pending, read_manifest, record
from stintlake.streaming.ingest import file_stream, ingest_available


def test_json_map_and_missing_file(spark, tmp_path):
    path = tmp_path / "circuits.json"
    path.write_text(json.dumps({"Monza": 5793, "Yas Island": 5281}))
    got = [(r.Location, r.length_m) for r in R.read_json_map(spark, str(path)).orderBy("file_order").collect()]
    assert got == [("Monza", 5793), ("Yas Island", 5281)]
    assert R.read_json_map(spark, str(tmp_path / "none.json")).count() == 0


def test_csv_with_marks(spark, tmp_path):
    name = "10_Some Grand Prix_lives_Some City_2023_tire_live_data.csv"
    (tmp_path / name).write_text(
        "﻿DriverID,Driver,Year,GranPrix,Location,Stint,Compound,TireLife,#TireMeters,NormalizedTireMeters\n"
        "10,ABC,2023,Some Grand Prix,Some City,1.0,MEDIUM,12.0,60000,0.5\n",
        encoding="utf-8",
    )
    row = R.read_csv(spark, str(tmp_path), STINT_LIVES).withColumns(
        {f"f_{n}": c for n, c in R.driver_file_columns(F.replace("source_file", F.lit("%20"), F.lit(" "))).items()}
    ).first()
    assert (row.DriverID, row.TireMeters, row.f_Year, row.f_Location) == (10, 60000, 2023, "Some City")
    named = R.read_csv_named(spark, str(tmp_path))
    assert "TireMeters" in named.columns and "DriverID" in named.columns


def test_rename_never_makes_two_columns_of_one_name(spark):
    df = spark.createDataFrame([(1, 2, 3)], "LapNumber int, lap_number int, driver int")
    assert R.standard_names(df).columns == ["LapNumber", "lap_number", "Driver"]


def test_manifest(spark, tmp_path):
    races = spark.createDataFrame([(2023, 1, "A"), (2023, 2, "B")], "Year int, RoundNumber int, EventName string")
    path = str(tmp_path / "manifest")
    assert pending(races, read_manifest(spark, path)).count() == 2
    record(races.where("RoundNumber = 1"), path)
    assert [r.EventName for r in pending(races, read_manifest(spark, path)).collect()] == ["B"]
    assert pending(races, read_manifest(spark, path), restart=True).count() == 2


def test_stream_takes_every_file_once_and_splits_bad_rows(spark, tmp_path):
    landing, target, bad, check = (str(tmp_path / n) for n in ("in", "out", "bad", "check"))
    df = spark.createDataFrame([(1, 90.0), (2, None)], "LapNumber int, LapTime double")
    rules = {"no lap time": ("lap", F.col("LapTime").isNull())}

    def run():
        stream = file_stream(spark, landing, df.schema, files_per_batch=1)
        ingest_available(stream, target, check, rules=rules, rejects=bad).awaitTermination()
        return spark.read.parquet(target).count(), spark.read.parquet(bad).count()

    df.coalesce(1).write.mode("append").parquet(landing)
    assert run() == (1, 1)
    assert run() == (1, 1)
    df.coalesce(1).write.mode("append").parquet(landing)
    assert run() == (2, 2)


def test_driver_csv_folders(spark, tmp_path):
    df = spark.createDataFrame([(1, "G", 2023, 5), (2, "G", 2023, 6)], "DriverID int, GranPrix string, Year int, LapNumber int")
    W.write_driver_csv(df, str(tmp_path / "csv"))
    assert (tmp_path / "csv" / "DriverID=1" / "GranPrix=G" / "Year=2023").is_dir()


ODD_LAPS = [
    (1, "G P", 2023, 5, ' "quoted", said ', 1.5),
    (1, "G P", 2023, None, None, None),
    (1, "G P", 2022, 6, "", -0.0),
    (2, "50% a/b=c:d", 2023, 7, "back\\slash", float("nan")),
    (None, None, None, 8, "é ☃", 1e300),
    (3, "", 2023, None, "x", None),
]
ODD_SCHEMA = "DriverID int, GranPrix string, Year int, LapNumber int, note string, LapTime double"
ODD_READ = "LapNumber int, note string, LapTime double, DriverID int, GranPrix string, Year int"


def _folders(path):
    """Lines of the files under each folder."""
    found = {}
    for file in path.glob("*/*/*/*.csv"):
        found.setdefault(str(file.parent.relative_to(path)), []).extend(file.read_text().split("\n"))
    return {k: sorted(v) for k, v in found.items()}


def test_driver_csv_is_what_spark_writes_and_reads(spark, tmp_path):
    rows = spark.createDataFrame(ODD_LAPS, ODD_SCHEMA)
    own, plain = tmp_path / "own", tmp_path / "plain"
    (own / "DriverID=9").mkdir(parents=True)  # of an earlier run
    W.write_driver_csv(rows, str(own))
    keys = ["DriverID", "GranPrix", "Year"]
    rows.hint("rebalance", *keys).write.option("header", True).partitionBy(*keys).csv(str(plain))
    assert _folders(own) == _folders(plain) and len(_folders(own)) == 5
    assert sorted(p.name for p in own.iterdir()) == ["DriverID=1", "DriverID=2", "DriverID=3", "DriverID=__HIVE_DEFAULT_PARTITION__", "_SUCCESS"]
    read = spark.read.option("header", True).schema(ODD_READ).csv(str(plain))
    got = W.read_driver_csv(spark, str(own), ODD_READ)
    assert got.dtypes == read.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, read.collect()))


def test_driver_csv_files_end_at_the_limit_and_tasks_share_folders(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 8).selectExpr("CAST(id % 3 AS INT) DriverID", "'G' GranPrix", "2023 Year", "CAST(id AS INT) LapNumber")
    for lap_files in (rows, rows.where("LapNumber < 0")):
        write_folder_csv(lap_files, str(tmp_path / "csv"), W.DRIVER_KEYS, 10)  # dealt anyhow: eight tasks have laps of a car
        read = W.read_driver_csv(spark, str(tmp_path / "csv"), "LapNumber int, DriverID int, GranPrix string, Year int")
        assert sorted(r.LapNumber for r in read.collect()) == sorted(r.LapNumber for r in lap_files.collect())
        assert read.where("DriverID <> LapNumber % 3").count() == 0
        sizes = [len(f.read_text().splitlines()) - 1 for f in tmp_path.glob("csv/*/*/*/*.csv")]
        assert sum(sizes) == lap_files.count() and max(sizes, default=10) == 10


def test_driver_csv_starts_no_process_per_folder(spark, tmp_path):
    rows = spark.range(400).selectExpr("CAST(id AS INT) DriverID", "'G' GranPrix", "2023 Year", "1 LapNumber")

    def started():
        return int(next(line for line in open("/proc/stat") if line.startswith("processes")).split()[1])

    W.write_driver_csv(rows.limit(1), str(tmp_path / "warm"))
    before = started()
    W.write_driver_csv(rows, str(tmp_path / "csv"))
    assert started() - before < 400


def test_failed_driver_csv_keeps_the_files_before(spark, tmp_path):
    rows = spark.createDataFrame([(1, "G", 2023, "5"), (2, "G", 2023, "x")], "DriverID int, GranPrix string, Year int, lap string")
    W.write_driver_csv(rows, str(tmp_path))
    before = _folders(tmp_path)
    with pytest.raises(Exception, match="x"):
        W.write_driver_csv(rows.withColumn("lap", F.when(F.col("lap") == "x", F.raise_error("x").cast("string")).otherwise("6")), str(tmp_path))
    assert _folders(tmp_path) == before and not (tmp_path / "_temporary").exists()


def test_dry_run_writes_nothing(spark, tmp_path):
    W.dry_run(spark.range(5))
    assert list(tmp_path.iterdir()) == []


def test_files_that_end_early_are_rejected_whole(spark, tmp_path):
    """A file damaged after its first row groups, one of other types, one without rows and one in a folder with a space."""
    folder = tmp_path / "land ed"
    rows = spark.range(100_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("lap_time"))
    rows.coalesce(1).write.option("parquet.block.size", 1 << 20).parquet(str(folder / "good"))
    spark.range(50).select(F.col("id").cast("string").alias("id")).coalesce(1).write.parquet(str(folder / "types"))
    rows.limit(0).coalesce(1).write.parquet(str(folder / "none"))
    whole = next((folder / "good").glob("*.parquet"))
    groups = pq.read_metadata(whole)
    last = groups.row_group(groups.num_row_groups - 1).column(1).data_page_offset
    content = bytearray(whole.read_bytes())
    content[last : last + 4000] = b"\xff" * 4000
    (folder / "damaged.parquet").write_bytes(content)

    sources = {"a": (str(folder), "*.parquet"), "b": (str(tmp_path / "lost"), "*")}
    read, rejects = R.read_sources(spark, sources, rows.schema)
    assert {(r.source_file, r.n) for r in read.groupBy("source_file").agg(F.count("LapTime").alias("n")).collect()} == {(whole.name, 100_000)}
    assert read.select("id").distinct().count() == 100_000 and "_path" not in read.columns
    reasons = {(r.source, r.path.split("/")[-1 if "damaged" in r.path else -2], r.reason) for r in rejects.collect() if r.source == "a"}
    assert reasons == {("a", "damaged.parquet", "incomplete"), ("a", "types", "unreadable"), ("a", "none", "empty")}
    assert [(r.path, r.reason) for r in rejects.where("source = 'b'").collect()] == [(str(tmp_path / "lost"), "missing")]
