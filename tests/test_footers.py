"""The file index: footers alone are read, and files are known by their full paths."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from stintlake.plans.unify import unify
from stintlake.sources import footers as FO
from stintlake.sources import readers as R

SCHEMA = "Year int, GranPrix string, lap_number int, LapTime double, Driver string"


def _write(folder, name, first, n, **columns):
    os.makedirs(folder, exist_ok=True)
    table = {"Year": pa.array([2023] * n, pa.int32()), "GranPrix": ["G"] * n, "lap_number": pa.array(range(first, first + n), pa.int32()), "LapTime": [None, *[90.0 + i for i in range(1, n)]]}
    pq.write_table(pa.table(table | columns), f"{folder}/{name}", row_group_size=7)


def test_index_says_what_the_files_hold(spark, tmp_path):
    _write(f"{tmp_path}/a", "2023_01_g.parquet", 1, 20, Driver=["x"] * 20)
    _write(f"{tmp_path}/a/sub {{1}}", "2023_01_g.parquet", 50, 5)
    schema = spark.createDataFrame([], SCHEMA).schema
    index = R.file_index(spark, {"a": (f"{tmp_path}/a", "*.parquet"), "b": (f"{tmp_path}/b", "*")}, schema)
    rows = {r.n_rows: r for r in index.collect()}
    assert rows[20].row_groups == 3 and rows[20].nulls["LapTime"] == 1 and rows[20].types["Driver"] == "string"
    assert (rows[20].low["lap_number"], rows[20].high["lap_number"], rows[20].high["LapTime"]) == (1, 20, 109.0)
    assert rows[None].reason == "missing" and rows[5].reason is None and rows[5].file != rows[20].file
    share = {r.n_rows: r.s for r in index.select("n_rows", FO.missing_pct(["LapTime", "Driver"]).alias("s")).collect()}
    assert share[20] == 2.5 and share[5] == 60.0
    hold = index.where("n_rows > 0").select("n_rows", FO.may_hold("lap_number", 30, 51).alias("h")).collect()
    assert {r.n_rows: r.h for r in hold} == {20: False, 5: True}


def test_a_large_broken_file_costs_its_end_only(spark, tmp_path):
    for name, size in (("huge.parquet", 3 << 30), ("tiny.parquet", 3), ("none.parquet", 0)):
        with open(tmp_path / name, "wb") as f:
            f.truncate(size)  # a hole: reading it all as one value would not fit
    files = R.discover(spark, {"a": (str(tmp_path), "*.parquet")})
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()
    found = FO.footers(files)
    assert {r.path.split("/")[-1]: (r.length, r.reason) for r in found.collect()} == {
        "huge.parquet": (3 << 30, "unreadable"),
        "tiny.parquet": (3, "unreadable"),
        "none.parquet": (0, "unreadable"),
    }


def test_equal_names_in_two_sources_and_folders(spark, tmp_path):
    _write(f"{tmp_path}/a", "2023_01_g.parquet", 1, 5)
    _write(f"{tmp_path}/b", "2023_01_g.parquet", 1, 150, Driver=["b"] * 150)
    _write(f"{tmp_path}/b/x", "2023_01_g.parquet", 100, 120, Driver=["x"] * 120)
    schema = spark.createDataFrame([], SCHEMA).schema
    sources = {n: (f"{tmp_path}/{n}", "*.parquet") for n in "ab"}
    done = unify(spark, sources, schema, ["Year", "LapNumber"], min_rows=100, max_missing_pct=10.0)
    assert [(r.source, r.path.split("/")[-2], r.reason) for r in done.rejects.collect()] == [("a", "a", "small")]
    assert {(r.Driver, r["count"]) for r in done.rows.groupBy("Driver").count().collect()} == {("b", 150), ("x", 69)}
    assert done.stats.first().duplicates_removed == 51
    assert sorted((r.n_rows, r.warn) for r in done.files.collect()) == [(120, False), (150, False)]
    # turned away by the footer: no row of the small file is read
    assert done.rows.where("source = 'a'").count() == 0


def test_repeats_in_one_file_keep_the_first_row(spark, tmp_path):
    table = pa.table({"Year": pa.array([2023] * 40, pa.int32()), "GranPrix": ["G"] * 40, "lap_number": pa.array([i % 4 for i in range(40)], pa.int32()), "LapTime": [float(i) for i in range(40)]})
    pq.write_table(table, f"{tmp_path}/f.parquet", row_group_size=3)
    schema = spark.createDataFrame([], SCHEMA).schema
    done = unify(spark, {"a": (str(tmp_path), "*")}, schema, ["Year", "LapNumber"], min_rows=1)
    assert sorted((r.LapNumber, r.LapTime) for r in done.rows.collect()) == [(0, 0.0), (1, 1.0), (2, 2.0), (3, 3.0)]


def test_stores_that_only_spark_opens_are_counted_without_columns(spark, tmp_path):
    _write(f"{tmp_path}/a", "f.parquet", 1, 20)
    (tmp_path / "a" / "g.parquet").write_bytes(b"nothing")
    sources = {"a": (f"{tmp_path}/a", "*.parquet")}
    schema = spark.createDataFrame([], SCHEMA).schema
    found = R._counted(spark, R.discover(spark, sources), sources, schema)
    assert sorted((r.n_rows or 0, r.reason) for r in found.collect()) == [(0, "without rows"), (20, None)]
    rows, rejects = R.read_files(spark, found, schema)
    assert rows.count() == 20 and rejects.count() == 1 and rows.agg(F.max("LapNumber")).first()[0] == 20
