"""Ad-hoc analysis of laps: neighbours and differences of every car on every lap."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stintlake.operators.laps import RACE
from stintlake.operators.neighbours import join_neighbours_exact
from stintlake.operators.stints import pit_detect


def lap_analysis(laps: DataFrame, signed: bool = False) -> DataFrame:
    """Lap and sector times, position, the cars around, the differences and the pit flag."""
    near = join_neighbours_exact(pit_detect(laps), signed)
    return near.select(
        *RACE,
        "DriverNumber",
        "Driver",
        "LapNumber",
        "Compound",
        "LapTime",
        "Sector1Time",
        "Sector2Time",
        "Sector3Time",
        "Position",
        "DriverAhead",
        "DriverBehind",
        "DiffToAhead",
        "DiffToBehind",
        "is_pit",
    )
