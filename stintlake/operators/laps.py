"""Lap records: projections and row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlake.functions import columns as C
from stintlake.functions.joins import join_small
from stintlake.functions.ordered import with_group_stats
from stintlake.functions.quantiles import group_quantiles

RACE = ["Year", "GranPrix"]
CAR = [*RACE, "DriverNumber"]

# Maxima by which the normalised weather and distance columns divide.
FIXED_MAXIMA = {
    "AirTemp": 61.0,
    "Humidity": 90.0,
    "TrackTemp": 61.0,
    "Pressure": 1013.0,
    "WindSpeed": 80.0,
    "WindDirection": 360.0,
    "TireMeters": 30466.0,
    "DriverMeters": 470884.0,
}


# -- projections -----------------------------------------------------------


def lap_record(laps: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The base row of a race table from a raw lap row with times in seconds, and the columns to ``keep``."""
    return laps.select(
        *RACE,
        "Location",
        F.col("DriverNumber").alias("DriverID"),
        "Driver",
        "Team",
        F.col("LapNumber").cast("int").alias("LapNumber"),
        F.col("Position").cast("int").alias("Position"),
        "LapTime",
        "Time",
        F.col("Stint").cast("int").alias("Stint"),
        F.coalesce("Compound", F.lit("UNKNOWN")).alias("Compound"),
        F.coalesce(F.col("TyreLife").cast("int"), F.lit(0)).alias("TyreLife"),
        F.coalesce("FreshTyre", F.lit(False)).alias("IsFreshTire"),
        F.col("PitInTime").isNotNull().alias("PitInTime"),
        F.col("PitOutTime").isNotNull().alias("PitOutTime"),
        *keep,
    )


def with_meters(laps: DataFrame, length: str = "length_m", unknown: float | None = None) -> DataFrame:
    """Tyre and driver distance; ``unknown`` is the length used where none is known."""
    size = F.col(length).cast("double")
    if unknown is not None:
        size = F.coalesce(size, F.lit(float(unknown)))
    return laps.withColumns(
        {"TireMeters": F.col("TyreLife") * size, "DriverMeters": F.col("LapNumber") * size}
    )


def meters_zero_branch(laps: DataFrame, length: str = "length_m") -> DataFrame:
    """Distances as whole metres; laps without tyre life keep their row with zeros and no compound."""
    used = F.coalesce(F.col("TyreLife") > 0, F.lit(False))
    size = F.coalesce(F.col(length), F.lit(0)).cast("long")

    def or_zero(c: Column) -> Column:
        return F.when(used, c).otherwise(0)

    return laps.withColumns(
        {
            "Stint": or_zero(F.col("Stint")).cast("int"),
            "TireMeters": or_zero(F.col("TyreLife").cast("long") * size),
            "DriverMeters": or_zero(F.col("LapNumber").cast("long") * size),
            "Compound": F.when(used, F.col("Compound")),
            "TyreLife": or_zero(F.col("TyreLife")).cast("double"),
        }
    )


def flags01(laps: DataFrame, pit_always: bool = False) -> DataFrame:
    """0/1 columns; ``pit_always`` reproduces tables in which both pit flags are always 1."""
    pit_in = F.lit(1) if pit_always else F.col("PitInTime").isNotNull().cast("int")
    pit_out = F.lit(1) if pit_always else F.col("PitOutTime").isNotNull().cast("int")
    return laps.withColumns(
        {
            "IsFreshTire": C.flag01(F.col("FreshTyre")),
            "PitIn": pit_in,
            "PitOut": pit_out,
            "Best": C.flag01(F.col("IsPersonalBest")),
        }
    )


def with_compound_code(laps: DataFrame, name: str = "CompoundCode") -> DataFrame:
    return laps.withColumn(name, C.compound_code("Compound"))


def encode_map(df: DataFrame, column: str, codes: DataFrame, key: str, code: str, name: str, default: int = -1):
    """Codes looked up in a table, ``default`` where there is none."""
    table = codes.select(F.col(key).alias("_key"), F.col(code).alias("_code"))
    return (
        join_small(df, table, F.col(column) == F.col("_key"))
        .withColumn(name, F.coalesce("_code", F.lit(default)))
        .drop("_key", "_code")
    )


def with_ids(laps: DataFrame, driver: str = "DriverID") -> DataFrame:
    year, race = F.col("Year").cast("string"), C.id_token("GranPrix")
    car = F.concat_ws("_", year, F.col(driver).cast("string"), race)
    return laps.withColumns(
        {
            "RaceID": F.concat_ws("_", year, race),
            "DriverRaceID": car,
            "GlobalLapID": F.concat_ws("_", car, F.col("LapNumber").cast("string")),
        }
    )


def position_features(laps: DataFrame) -> DataFrame:
    p = F.col("Position")
    return laps.withColumns(
        {
            "position_inverted": 21 - p,
            "is_top_3": C.flag01(p <= 3),
            "is_points_position": C.flag01(p <= 10),
        }
    )


def log_deltas(laps: DataFrame) -> DataFrame:
    return laps.withColumns(
        {
            "log_delta_ahead": F.log1p(F.abs("TimeDeltaToDriverAhead")),
            "log_delta_behind": F.log1p(F.abs("TimeDeltaToDriverBehind")),
        }
    )


def weather_flags(laps: DataFrame) -> DataFrame:
    hard = (
        F.coalesce(F.col("Rainfall"), F.lit(False))
        | F.coalesce(F.col("Humidity") > 80, F.lit(False))
        | F.coalesce(F.col("WindSpeed") > 15, F.lit(False))
    )
    return laps.withColumns(
        {
            "difficult_conditions": hard.cast("int"),
            "temp_delta": F.col("TrackTemp") - F.col("AirTemp"),
        }
    )


def domain_stint(laps: DataFrame) -> DataFrame:
    typical = C.lookup("Compound", C.TYPICAL_STINT, C.TYPICAL_STINT_OTHER)
    return laps.withColumn("expected_stint_length_domain", typical).withColumn(
        "stint_length_ratio", F.col("TyreLife") / F.col("expected_stint_length_domain")
    )


def pit_windows(laps: DataFrame) -> DataFrame:
    spans = {"early": (10, 20), "mid": (35, 45), "late": (55, 65)}
    return laps.withColumns(
        {f"in_pit_window_{n}": C.flag01(F.col("LapNumber").between(*s)) for n, s in spans.items()}
    )


def likely_stops(laps: DataFrame) -> DataFrame:
    stint, ratio = F.col("Stint"), F.col("stint_length_ratio")
    return laps.withColumns(
        {
            "likely_one_stop": F.coalesce((stint == 1) & (ratio > 1.5), F.lit(False)),
            "likely_two_stop": F.coalesce((stint >= 2) & (ratio < 1.2), F.lit(False)),
        }
    )


def fixed_norm(laps: DataFrame, maxima: dict[str, float] = FIXED_MAXIMA) -> DataFrame:
    """``Normalized<c>`` for the columns that are present."""
    return laps.withColumns(
        {f"Normalized{c}": F.col(c) / top for c, top in maxima.items() if c in laps.columns}
    )


def select_strategy(laps: DataFrame) -> DataFrame:
    return laps.select(*RACE, "Driver", "Stint", "Compound", "LapNumber")


def lap_table(laps: DataFrame) -> DataFrame:
    return laps.select(*RACE, "Driver", "LapNumber", "LapTime", "Compound", "Position")


def laptime_series(laps: DataFrame) -> DataFrame:
    """Lap times for drawing, sorted by driver and lap."""
    return laps.select(*RACE, "Driver", "LapNumber", "LapTime").orderBy(*RACE, "Driver", "LapNumber")


# -- filters ---------------------------------------------------------------


def pick_drivers(laps: DataFrame, drivers: list[str], column: str = "Driver") -> DataFrame:
    return laps.where(F.col(column).isin(drivers))


def pick_tyre(laps: DataFrame, compound: str) -> DataFrame:
    return laps.where(F.col("Compound") == compound)


def pick_lap(laps: DataFrame, number: int) -> DataFrame:
    return laps.where(F.col("LapNumber") == number)


def pick_team(laps: DataFrame, results: DataFrame, team: str) -> DataFrame:
    """Laps of the drivers that the results list for a team."""
    cars = results.where(F.col("TeamName") == team).select(*CAR)
    return laps.join(cars, CAR, "left_semi")


def pick_quicklaps(laps: DataFrame, threshold: float = 1.07, by: list[str] = RACE) -> DataFrame:
    """Laps faster than ``threshold`` times the fastest lap of their session."""
    best = with_group_stats(laps, by, {"_best": F.min("LapTime")})
    return best.where(F.col("LapTime") < threshold * F.col("_best")).drop("_best")


def pick_accurate(laps: DataFrame) -> DataFrame:
    return laps.where("IsAccurate")


def valid_laps(laps: DataFrame) -> DataFrame:
    return laps.where(
        F.col("IsAccurate")
        & F.col("LapTime").isNotNull()
        & F.col("PitInTime").isNull()
        & F.col("PitOutTime").isNull()
    )


def clean(laps: DataFrame, driver: str = "DriverID") -> DataFrame:
    """Rows with usable keys and a plausible lap and position, after numeric coercion."""
    typed = laps.withColumns(
        {
            **{c: F.col(c).cast("string").try_cast("int") for c in ("Year", "LapNumber", "Position")},
            driver: F.col(driver).cast("string").try_cast("long"),
        }
    )
    return typed.where(
        F.col("Year").isNotNull()
        & F.col(driver).isNotNull()
        & (F.col("LapNumber") > 0)
        & (F.col("LapNumber") <= 100)
        & (F.col("Position") > 0)
        & (F.col("Position") <= 25)
    )


def quantile_trim(df: DataFrame, value: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Rows whose value lies within two quantiles of the column."""
    bounds = group_quantiles(df, [], value, {"lo": low, "hi": high})
    row = bounds.select(F.struct("lo", "hi").alias("_b")).scalar()
    return (
        df.withColumn("_b", row)
        .where(F.col(value).between(F.col("_b.lo"), F.col("_b.hi")))
        .drop("_b")
    )


def winner_split(laps: DataFrame, results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Laps of the race winners, and laps of everybody else."""
    winners = results.where(F.col("Position") == 1).select(*CAR)
    return join_small(laps, winners, CAR, "left_semi"), join_small(laps, winners, CAR, "left_anti")
