"""Writing tables: consolidated, per race, per driver, per split, reports, dry runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlake.functions.columns import sanitize_event
from stintlake.sources.folder_csv import local_path, read_folder_csv, write_folder_csv

DRIVER_KEYS = ["DriverID", "GranPrix", "Year"]


def write_consolidated(df: DataFrame, path: str) -> None:
    """One table partitioned by year.

    Rows are brought together by year before they are written, so that not
    every task leaves a file in every folder; AQE splits a large year again.
    """
    df.hint("rebalance", "Year").write.mode("overwrite").option("compression", "snappy").partitionBy("Year").parquet(path)


def write_race_files(df: DataFrame, path: str, event: str = "EventName") -> None:
    """One folder per race.

    The race's place is in the folder names and a ``race_file`` column keeps
    the ``{year}_{round}_{event}`` name of the race.
    """
    name = F.concat_ws(
        "_", F.col("Year").cast("string"), F.lpad(F.col("RoundNumber").cast("string"), 2, "0"), sanitize_event(event)
    )
    races = df.withColumn("race_file", name).hint("rebalance", "Year", "RoundNumber")
    races.write.mode("overwrite").partitionBy("Year", "RoundNumber").parquet(path)


def write_driver_csv(df: DataFrame, path: str, max_rows: int = 1_000_000) -> None:
    """CSV files in one folder per car, race and year.

    A car's laps meet in one task by the shuffle AQE plans, which also splits
    a large one; files never pass ``max_rows``. On a local file system the
    tasks write the files themselves, as ``folder_csv`` says.
    """
    rows, local = df.hint("rebalance", "DriverID"), local_path(df.sparkSession, path)
    if local is not None:
        return write_folder_csv(rows, local, DRIVER_KEYS, max_rows)
    (
        rows.write.mode("overwrite")
        .option("header", True)
        .option("maxRecordsPerFile", max_rows)
        .partitionBy(*DRIVER_KEYS)
        .csv(path)
    )


def read_driver_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of ``write_driver_csv``; ``schema`` holds the files' columns in order and the three of the folders."""
    local = local_path(spark, path)
    if local is not None:
        return read_folder_csv(spark, local, schema, DRIVER_KEYS)
    return spark.read.option("header", True).schema(schema).csv(path)


def write_splits(split: DataFrame, path: str, features: list[str] | None = None) -> None:
    """Train, validation and test rows in one write, with the list of feature columns beside them."""
    split.hint("rebalance", "split").write.mode("overwrite").partitionBy("split").parquet(f"{path}/data")
    if features is not None:
        names = split.sparkSession.createDataFrame([(n, i) for i, n in enumerate(features)], "name string, place int")
        names.coalesce(1).write.mode("overwrite").parquet(f"{path}/feature_columns")


def write_report(stats: DataFrame, path: str) -> None:
    """A small table of statistics as JSON."""
    stats.coalesce(1).write.mode("overwrite").json(path)


def dry_run(df: DataFrame) -> None:
    """Run the whole job and write nothing."""
    df.write.format("noop").mode("overwrite").save()
