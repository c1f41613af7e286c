"""Skipping what has been processed, recording what was, and replacing races that were extracted again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlake.functions.joins import join_small
from stintlake.session import stage

KEYS = ["Year", "RoundNumber"]
MANIFEST_SCHEMA = "Year int, RoundNumber int, EventName string"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Processed races; empty when nothing was recorded yet."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)


def pending(races: DataFrame, manifest: DataFrame, restart: bool = False, keys: list[str] = KEYS) -> DataFrame:
    """Races that are not in the manifest; all of them after a ``restart``."""
    return races if restart else races.join(manifest.select(*keys).distinct(), keys, "left_anti")


def record(races: DataFrame, path: str) -> None:
    """Add processed races to the manifest."""
    races.select(*KEYS, "EventName").distinct().write.mode("append").parquet(path)


def progress(races: DataFrame, manifest: DataFrame) -> DataFrame:
    """Planned and completed races and the share done, in percent."""
    done = manifest.select(*KEYS).distinct().withColumn("_done", F.lit(1))
    return (
        races.select(*KEYS)
        .distinct()
        .join(done, KEYS, "left")
        .agg(F.count("*").alias("planned"), F.count("_done").alias("completed"))
        .withColumn("pct", F.coalesce(F.try_divide(F.col("completed") * 100, F.col("planned")), F.lit(0.0)))
    )


# -- races in versions -------------------------------------------------------

LANDED_SCHEMA = "EventName string, n_rows long, digest decimal(38,0), Year int, RoundNumber int"


def digests(rows: DataFrame, event: str = "GranPrix") -> DataFrame:
    """One row per race with its size and a digest of its rows that does not depend on their order."""
    row = F.xxhash64(*sorted(rows.columns)).cast("decimal(38,0)")
    return rows.groupBy(*KEYS).agg(F.max(event).alias("EventName"), F.count("*").alias("n_rows"), F.sum(row).cast("decimal(38,0)").alias("digest"))


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """The manifest of landed races with their digests; empty when nothing has landed."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path):
        return spark.createDataFrame([], LANDED_SCHEMA)
    return spark.read.schema(LANDED_SCHEMA).parquet(path)


def changed(rows: DataFrame, landed: DataFrame, event: str = "GranPrix") -> DataFrame:
    """Races of ``rows`` that have not landed as they are now."""
    same = [*KEYS, "n_rows", "digest"]
    return digests(rows, event).join(landed.select(*same), same, "left_anti").select(*KEYS)


def overwrite_races(rows: DataFrame, target: str) -> None:
    """Put the races of ``rows`` in place of what ``target`` has of them; other races are not touched."""
    parts = rows.hint("rebalance", *KEYS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    parts.partitionBy(*KEYS).parquet(target)


def note_races(races: DataFrame, target: str, manifest: str, columns: list[str], event: str = "GranPrix") -> None:
    """Write down, race by race, what ``target`` now has of ``races``, in place of what was noted before."""
    table = races.sparkSession.read.parquet(target).select(*columns)
    now = digests(join_small(table, races.select(*KEYS).distinct(), KEYS, "left_semi"), event)
    now.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*KEYS).parquet(manifest)


def land_races(rows: DataFrame, target: str, manifest: str, event: str = "GranPrix") -> None:
    """Land races, or land them again corrected: their folders and their lines of the manifest are replaced.

    Both steps can be run again after a failure in or between them and end with one version of each race. ``rows`` must have
    a race whole and is read twice; columns are those of the target.
    """
    overwrite_races(rows, target)
    note_races(rows, target, manifest, rows.columns, event)


def land_changed(rows: DataFrame, target: str, manifest: str, event: str = "GranPrix") -> None:
    """Land the races of ``rows`` that the manifest does not have as they are."""
    races = changed(rows, read_landed(rows.sparkSession, manifest), event)
    fresh = stage(join_small(rows, races, KEYS, "left_semi"), "corrected")
    if not fresh.isEmpty():
        land_races(fresh, target, manifest, event)
