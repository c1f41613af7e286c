"""Schedules, race lists and rosters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlake.functions.ordered import OrderedGroups


def conventional(schedule: DataFrame, first: int | None = None) -> DataFrame:
    """Conventional events, of each year only the ``first`` few when asked."""
    rows = schedule.where(F.col("EventFormat") == "conventional")
    if first is None:
        return rows
    g = OrderedGroups(rows, ["Year"], ["RoundNumber", "EventName"]).numbered("_n")
    return g.result().where(F.col("_n") <= first).drop("_n")


def session5_races(schedule: DataFrame) -> DataFrame:
    return schedule.where(F.col("Session5") == "Race")


def race_list(schedule: DataFrame, removed: DataFrame) -> DataFrame:
    """Locations per year; every row of ``removed`` takes one listing of its location away."""
    return schedule.select("Year", "Location").exceptAll(removed.select("Year", "Location"))


def available_events(schedule: DataFrame, year: int) -> DataFrame:
    return schedule.where(F.col("Year") == year).select("EventName").distinct()


def available_drivers(results: DataFrame, year: int, event: str) -> DataFrame:
    at = (F.col("Year") == year) & (F.col("GranPrix") == event)
    return results.where(at).select("DriverNumber", "Abbreviation").distinct()


def roster(results: DataFrame) -> DataFrame:
    """Driver codes per year as seen in the results."""
    return results.select("Year", F.col("Abbreviation").alias("Driver")).distinct()


def roster_from_map(spark: SparkSession, names: dict[int, list[str]], column: str = "Driver") -> DataFrame:
    """A year -> names parameter as a lookup table."""
    table = spark.createDataFrame([(names,)], "names map<int, array<string>>")
    return table.select(F.explode("names").alias("Year", "_n")).select("Year", F.explode("_n").alias(column))
