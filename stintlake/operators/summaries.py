"""Summaries of files that add up: a run reads its new files and merges what earlier runs have stored.

Counts are exact. Distinct values are counted by sketches of a fixed size; sets hold the least values, up to a limit, and
say whether there are more.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Log of a sketch's registers, and the most values of a set.
SKETCH, VALUES = 12, 40


def relative_error(lg: int = SKETCH) -> float:
    """Standard error of a distinct count."""
    return 1.04 / math.sqrt(1 << lg)


def _name(columns: tuple[str, ...]) -> str:
    return "_".join(columns)


def _key(columns: tuple[str, ...]) -> Column:
    """One number for the values of all columns; null if one of them is missing."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return F.when(known, F.xxhash64(*columns))


def _least(df: DataFrame, by: list[str], column: str, most: int) -> DataFrame:
    """The least distinct values of ``column`` by group and whether there are more; no group is gathered for it."""
    values = df.where(F.col(column).isNotNull()).select(*by, F.col(column).alias("_v")).distinct()
    place = F.row_number().over(Window.partitionBy(*by).orderBy("_v"))
    few = values.withColumn("_place", place).where(F.col("_place") <= most + 1)
    found = few.groupBy(*by).agg(F.array_sort(F.collect_list("_v")).alias(f"set_{column}"))
    return found.withColumns({f"more_{column}": F.size(f"set_{column}") > most, f"set_{column}": F.slice(f"set_{column}", 1, most)})


def file_summaries(
    df: DataFrame,
    file: str = "file",
    distinct: tuple[tuple[str, ...], ...] = (("DriverID",), ("LapNumber",), ("Year", "GranPrix")),
    sets: tuple[str, ...] = ("Year", "GranPrix"),
    bad: dict[str, Column] | None = None,
    run: int = 0,
    lg: int = SKETCH,
    most: int = VALUES,
) -> DataFrame:
    """One row per file: rows, missing cells, rows that are ``bad`` by each rule, a sketch per key of ``distinct``, sets."""
    data = [c for c in df.columns if c != file]
    nulls = sum((F.col(c).isNull().cast("long") for c in data), F.lit(0).cast("long"))
    aggs = [F.count("*").alias("n_rows"), F.sum(nulls).alias("missing_values")]
    aggs += [F.hll_sketch_agg(_key(k), F.lit(lg)).alias(f"sketch_{_name(k)}") for k in distinct]
    aggs += [F.count_if(rule).alias(f"bad_{name}") for name, rule in (bad or {}).items()]
    out = df.groupBy(file).agg(*aggs)
    for c in sets:
        out = out.join(_least(df, [file], c, most), file, "left")
    return out.withColumn("run", F.lit(run))


def store(summaries: DataFrame, path: str) -> None:
    """Add the summaries of a run's files to those of earlier runs."""
    summaries.write.mode("append").parquet(path)


def stored(spark: SparkSession, path: str, file: str = "file") -> DataFrame:
    """The summary of every file, that of the last run for a file summed up twice."""
    rows = spark.read.parquet(path)
    last = rows.groupBy(file).agg(F.max(F.struct("run", *[c for c in rows.columns if c not in ("run", file)])).alias("_s"))
    return last.select(file, "_s.*")


def merged(summaries: DataFrame, most: int = VALUES) -> DataFrame:
    """One row for all files: sums of the counts, estimates of the distinct counts, sets of the least values."""
    names = summaries.columns
    aggs = [F.count("*").alias("files"), F.sum("n_rows").alias("rows"), F.sum("missing_values").alias("missing_values")]
    aggs += [F.sum(c).alias(c) for c in names if c.startswith("bad_")]
    aggs += [F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c.removeprefix("sketch_")) for c in names if c.startswith("sketch_")]
    out = summaries.agg(*aggs)
    for c in (n.removeprefix("set_") for n in names if n.startswith("set_")):
        more = summaries.agg(F.coalesce(F.max(f"more_{c}"), F.lit(False)).alias("m")).scalar()
        values = summaries.select(F.explode(f"set_{c}").alias(c)).distinct().orderBy(c).limit(most + 1)
        least = values.agg(F.array_sort(F.collect_list(c)).alias("s")).scalar()
        out = out.withColumns({f"set_{c}": F.slice(least, 1, most), f"more_{c}": more | (F.size(least) > most)})
    return out
