"""One table out of many sources: index, gate, read, drop repeats, order, with its figures."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stintlake.operators import quality as Q
from stintlake.sources.footers import missing_pct
from stintlake.sources.readers import file_index, read_files


@dataclass(frozen=True)
class Unified:
    """``rows`` of all accepted files; ``rejects`` with ``source``, ``path`` and ``reason``; ``stats`` in one row; ``files``
    with rows, missing cells in percent and whether to warn, of those that were accepted."""

    rows: DataFrame
    rejects: DataFrame
    stats: DataFrame
    files: DataFrame


def unify(
    spark: SparkSession,
    sources: dict[str, tuple[str, str]],
    schema: T.StructType,
    key: list[str],
    min_rows: int = 100,
    max_missing_pct: float = 30.0,
) -> Unified:
    """Sources under one schema; of rows with one ``key`` the first by source, path and place in the file stays.

    Files are known by source and full path, so equal names do not meet. Those with fewer than ``min_rows`` rows are turned
    away as ``small`` by their footers, before a row is read.
    """
    index = file_index(spark, sources, schema)
    small = F.when(F.col("reason").isNull() & (F.col("n_rows") < min_rows), F.lit("small"))
    read, rejects = read_files(spark, index.withColumn("reason", F.coalesce("reason", small)), schema)
    rows = Q.dedupe_first(read, key, ["source", "source_path", "source_row"])
    share = missing_pct(schema.fieldNames()).alias("missing_pct")
    files = index.join(rejects, ["source", "file"], "left_anti").select("source", "path", "n_rows", share)
    plain = rows.drop("source_path", "source_row")
    return Unified(
        plain, rejects.select("source", "path", "reason"), Q.unify_stats(read, plain), files.withColumn("warn", F.col("missing_pct") > max_missing_pct)
    )
