"""Weather samples attached to laps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.functions.asof import Samples, align, interval_stats, nearest_of
from stintlake.functions.joins import join_small
from stintlake.operators.laps import RACE

MEASURES = ["AirTemp", "Humidity", "TrackTemp", "Pressure", "WindSpeed", "WindDirection"]
RAIN = "Rainfall"


def _stats(laps, weather, car, lap, start, end, tie, means=MEASURES, lasts=None):
    return interval_stats(
        laps,
        weather,
        RACE,
        [car, lap],
        start,
        end,
        "Time",
        means,
        [RAIN],
        lasts,
        tie,
    )


def join_weather_avg(
    laps: DataFrame,
    weather: DataFrame,
    car: str = "DriverNumber",
    lap: str = "LapNumber",
    start: str = "LapStartTime",
    end: str = "Time",
    nearest: bool = True,
    rain_unknown: bool | None = None,
    tie: str | None = None,
    spans: DataFrame | None = None,
) -> DataFrame:
    """Mean of every measure and any rain over the samples taken during the lap.

    A lap without samples takes the sample nearest to its start (the earlier of
    two) unless ``nearest`` is off. Laps without times, and races without
    weather, get nulls; their rain flag is ``rain_unknown``. ``spans`` may be an
    earlier form of ``laps`` to take the lap times from.
    """
    stats = _stats(laps if spans is None else spans, weather, car, lap, start, end, tie)
    # the samples around a lap's start are only looked at if it has none of its own
    stats = stats.withColumns({c: F.when(F.col("n") == 0, F.col(c)) for c in ("before", "after")})
    out = laps.join(stats, [*RACE, car, lap], "left")
    inside = F.col("n") > 0

    def value(field: str, mean: str):
        if not nearest:
            return F.when(inside, F.col(mean))
        return F.when(inside, F.col(mean)).otherwise(nearest_of("before", "after", F.col(start), field))

    measured = {c: value(c, f"{c}_mean") for c in MEASURES}
    rain = value(RAIN, f"{RAIN}_any")
    if rain_unknown is not None:
        rain = F.coalesce(rain, F.lit(rain_unknown))
    drop = ["n", "before", "after", f"{RAIN}_any", *[f"{c}_mean" for c in MEASURES]]
    return out.withColumns({**measured, RAIN: rain}).drop(*drop)


def join_weather_last_over_n(
    laps: DataFrame,
    weather: DataFrame,
    car: str = "DriverNumber",
    lap: str = "LapNumber",
    start: str = "LapStartTime",
    end: str = "Time",
    tie: str | None = None,
) -> DataFrame:
    """The last sample of the lap divided by the number of samples, and whether it was raining then.

    This is how the older per-driver tables were filled.
    """
    stats = _stats(laps, weather, car, lap, start, end, tie, means=[], lasts=[*MEASURES, RAIN])
    picked = stats.select(
        *RACE,
        car,
        lap,
        *[F.try_divide(F.col(f"{c}_last"), F.col("n")).alias(c) for c in MEASURES],
        F.col(f"{RAIN}_last").cast("int").alias(RAIN),
    )
    return laps.join(picked, [*RACE, car, lap], "left")


def join_lap_weather_nearest(
    laps: DataFrame,
    weather: DataFrame,
    start: str = "LapStartTime",
    car: str = "DriverNumber",
    tie: str | None = None,
) -> DataFrame:
    """Rain (0/1) and track temperature from the sample nearest to the lap's start."""
    samples = Samples(weather, "Time", [RAIN, "TrackTemp"], tie)
    found = align(laps, RACE, start, [car, "LapNumber"], {"sample": samples})
    return found.withColumns(
        {RAIN: F.col(f"sample.{RAIN}").cast("int"), "TrackTemp": F.col("sample.TrackTemp")}
    ).drop("sample")


def track_temp_series(weather: DataFrame, schedule: DataFrame) -> DataFrame:
    """Track temperature over time of every conventional event."""
    events = schedule.where(F.col("EventFormat") == "conventional").select(
        "Year", F.col("EventName").alias("GranPrix")
    )
    return (
        join_small(weather, events, RACE, "left_semi")
        .select(*RACE, "Time", "TrackTemp")
        .orderBy(*RACE, "Time")
    )
