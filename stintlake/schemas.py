"""Schemas of the landed tables."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "i": T.IntegerType(),
    "l": T.LongType(),
    "d": T.DoubleType(),
    "s": T.StringType(),
    "b": T.BooleanType(),
    "t": T.TimestampType(),
}


def _schema(text: str) -> T.StructType:
    fields = [f.split(":") for f in text.split()]
    return T.StructType([T.StructField(n, _TYPES[t], True) for n, t in fields])


LAPS_RAW = _schema(
    """Year:i GranPrix:s Location:s DriverNumber:s Driver:s Team:s LapNumber:d Position:d Stint:d TyreLife:d
    Compound:s FreshTyre:b IsPersonalBest:b IsAccurate:b LapTime:d LapStartTime:d Time:d PitInTime:d PitOutTime:d
    Sector1Time:d Sector2Time:d Sector3Time:d Sector1SessionTime:d Sector2SessionTime:d Sector3SessionTime:d"""
)
WEATHER = _schema(
    """Year:i GranPrix:s Time:d AirTemp:d Humidity:d TrackTemp:d Pressure:d WindSpeed:d WindDirection:d Rainfall:b"""
)
RESULTS = _schema("Year:i GranPrix:s DriverNumber:s Abbreviation:s TeamName:s Position:d Time:d")
SCHEDULE = _schema(
    "Year:i RoundNumber:i EventName:s OfficialEventName:s Location:s EventFormat:s Session5:s"
)
TELEMETRY = _schema(
    """Year:i GranPrix:s Driver:s LapNumber:i Time:d Date:t Speed:d RPM:d nGear:i Throttle:d Brake:d DRS:i
    Distance:d X:d Y:d"""
)
CORNERS = _schema("circuit:s Number:i Letter:s X:d Y:d Angle:d rotation:d")
RACE_LAPS = _schema(
    """Year:i GranPrix:s Location:s DriverID:s Driver:s Team:s LapNumber:i Position:i LapTime:d Time:d Stint:i
    Compound:s TyreLife:i IsFreshTire:b PitInTime:b PitOutTime:b TireMeters:d DriverMeters:d AirTemp:d Humidity:d
    TrackTemp:d Pressure:d WindSpeed:d WindDirection:d Rainfall:b TimeDeltaToDriverAhead:d
    TimeDeltaToDriverTwoAhead:d TimeDeltaToDriverBehind:d TimeDeltaToDriverTwoBehind:d"""
)
STINT_LIVES = _schema(
    """DriverID:i Driver:s Year:i GranPrix:s Location:s Stint:d Compound:s TireLife:d TireMeters:l
    NormalizedTireMeters:d"""
)
