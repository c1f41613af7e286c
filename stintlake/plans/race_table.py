"""From raw laps, weather and circuits to the race table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stintlake.operators import laps as L
from stintlake.operators.circuits import join_circuit
from stintlake.operators.neighbours import time_deltas
from stintlake.operators.weather import join_weather_avg

COLUMNS = [
    "Year",
    "GranPrix",
    "Location",
    "DriverID",
    "Driver",
    "Team",
    "LapNumber",
    "Position",
    "LapTime",
    "Time",
    "Stint",
    "Compound",
    "TyreLife",
    "IsFreshTire",
    "PitInTime",
    "PitOutTime",
    "TireMeters",
    "DriverMeters",
    "AirTemp",
    "Humidity",
    "TrackTemp",
    "Pressure",
    "WindSpeed",
    "WindDirection",
    "Rainfall",
    "TimeDeltaToDriverAhead",
    "TimeDeltaToDriverTwoAhead",
    "TimeDeltaToDriverBehind",
    "TimeDeltaToDriverTwoBehind",
]


def race_table(
    laps: DataFrame, weather: DataFrame, circuits: DataFrame, weather_tie: str | None = None
) -> DataFrame:
    """All laps of all races with distance, weather and gaps.

    Every step reads the raw laps rather than the output of the step before
    where it can, so that looking at the keys of one step never runs another.
    """
    base = L.lap_record(laps, keep=("LapStartTime",))
    gaps = time_deltas(base, car="DriverID")
    weathered = join_weather_avg(gaps, weather, car="DriverID", tie=weather_tie, spans=base)
    return L.with_meters(join_circuit(weathered, circuits, places=base)).select(*COLUMNS)
