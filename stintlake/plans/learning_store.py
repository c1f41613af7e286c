"""Learning data on disk: rows and sequences of all splits in buckets of the car, and what was fitted beside them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlake.operators import mldata as M
from stintlake.operators.features import CAR_ID
from stintlake.plans.lap_dataset import Prepared
from stintlake.sources.bucketed import read_bucketed, write_bucketed

SPLITS = ("train", "val", "test")


@dataclass
class Stored:
    """What ``save`` wrote, read again. ``codes`` are by column."""

    spark: SparkSession
    path: str
    codes: dict[str, DataFrame]
    scaling: DataFrame
    scaled: list[str]
    features: list[str]
    length: int

    def rows(self, split: str) -> DataFrame:
        return read_bucketed(self.spark, f"{self.path}/rows/{split}")

    def sequences(self, split: str) -> DataFrame:
        return read_bucketed(self.spark, f"{self.path}/sequences/{split}")

    def made_sequences(self, split: str) -> DataFrame:
        """Sequences made of the stored rows; no exchange, as the rows lie by car."""
        rows = M.label_encode(self.rows(split), "next_tire_type", self.codes["Compound"], "_type")
        return M.sequences(rows, self.features, self.length, "_type")

    def applied(self, rows: DataFrame) -> DataFrame:
        """Other rows encoded and scaled as the stored ones were."""
        for c, table in self.codes.items():
            rows = M.label_encode(rows, c, table)
        return M.robust_scale(rows, self.scaled, self.scaling)


def save(prepared: Prepared, path: str, buckets: int = 64, length: int = 10) -> Stored:
    """Write splits, codes, quartiles and the feature list, then the sequences from the rows just written."""
    spark = prepared.rows.sparkSession
    codes = [t.select(F.lit(c).alias("column"), "value", "code") for c, t in prepared.codes.items()]
    reduce(DataFrame.unionByName, codes).coalesce(1).write.mode("overwrite").parquet(f"{path}/codes")
    prepared.scaling.write.mode("overwrite").parquet(f"{path}/scaling")
    names = [("feature", i, n) for i, n in enumerate(prepared.features)] + [("scaled", i, n) for i, n in enumerate(prepared.scaled)]
    names.append(("length", length, ""))
    spark.createDataFrame(names, "kind string, place int, name string").coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")
    for split in SPLITS:
        rows = prepared.rows.where(F.col("split") == split).drop("split")
        write_bucketed(rows, f"{path}/rows/{split}", CAR_ID, ["LapNumber"], buckets)
    stored = load(spark, path)
    for split in SPLITS:
        write_bucketed(stored.made_sequences(split), f"{path}/sequences/{split}", CAR_ID, ["LapNumber"], buckets)
    return stored


def load(spark: SparkSession, path: str) -> Stored:
    """Everything ``save`` wrote but the rows, which are read when asked for."""
    codes = spark.read.parquet(f"{path}/codes")
    columns = [r[0] for r in codes.select("column").distinct().orderBy("column").collect()]  # a few names
    found: dict[str, list[str]] = {"feature": [], "scaled": []}
    length = 10
    for r in spark.read.parquet(f"{path}/columns").orderBy("kind", "place").collect():
        if r["kind"] == "length":
            length = r["place"]
        else:
            found[r["kind"]].append(r["name"])
    tables = {c: codes.where(F.col("column") == c).select("value", "code") for c in columns}
    return Stored(spark, path, tables, spark.read.parquet(f"{path}/scaling"), found["scaled"], found["feature"], length)
