"""New race files from a landing folder to a table, each exactly once.

The checkpoint is the manifest: a run takes the files that arrived since the
last one and stops, and a run after a failure resumes where it was.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stintlake.functions.joins import join_small
from stintlake.operators.quality import split_valid
from stintlake.session import stage
from stintlake.sources.incremental import KEYS, land_changed
from stintlake.sources.readers import race_file_columns, standard_names


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Race files as a stream, with year, round and event from their names."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.parquet(path).withColumn("source_file", F.col("_metadata.file_name"))
    found = {n: c for n, c in race_file_columns("source_file").items() if n not in rows.columns}
    return standard_names(rows.withColumns(found))


def ingest_corrected(
    spark: SparkSession, path: str, schema: T.StructType, target: str, manifest: str, checkpoint: str, event: str = "GranPrix"
) -> StreamingQuery:
    """Take up race files, each with whole races, and put them in place of earlier versions; stop when all are taken.

    Of several files with one race the last written counts, in a batch and from batch to batch. A batch that is run again
    after a failure replaces the same races by the same rows.
    """
    rows = spark.readStream.schema(schema).parquet(path)
    rows = rows.withColumns({"_when": F.col("_metadata.file_modification_time"), "_file": F.col("_metadata.file_path")})

    def write(batch: DataFrame, epoch: int) -> None:
        found = stage(batch, "corrected")
        version = F.struct("_when", "_file")
        last = found.groupBy(*KEYS).agg(F.max(version).alias("_last"))
        kept = join_small(found, last, KEYS, "inner").where(version == F.col("_last")).drop("_when", "_file", "_last")
        land_changed(kept.select(*schema.fieldNames()), target, manifest, event)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_available(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    rules: dict | None = None,
    rejects: str | None = None,
) -> StreamingQuery:
    """Process what is there and stop.

    With ``rules`` bad rows go to ``rejects`` with level and reason, which must
    then be given. A batch is read and checked once, and one that is run again
    after a failure overwrites its own folders only.
    """
    if rules and not rejects:
        raise ValueError("rules need a folder for the rows they reject")

    def write(batch: DataFrame, epoch: int) -> None:
        rows = transform(batch) if transform else batch
        if rules:
            rows = rows.persist(StorageLevel.DISK_ONLY_2)
            good, bad = split_valid(rows, rules)
            bad.write.mode("overwrite").parquet(f"{rejects}/batch={epoch}")
        else:
            good = rows
        good.write.mode("overwrite").parquet(f"{target}/batch={epoch}")
        if rules:
            rows.unpersist()

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
