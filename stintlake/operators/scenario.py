"""What-if columns on lap tables: fuel load and tyre wear."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlake.functions.ordered import with_group_stats
from stintlake.operators.laps import RACE

# Base lap time, seconds per lap beyond the knee, and the knee, per compound.
TYRE_MODEL = {"SOFT": (90.0, 0.5, 10), "MEDIUM": (91.0, 0.3, 15)}


def fuel_remaining(
    laps: DataFrame, initial: float = 110.0, rate: float = 3.0, reserve: float | None = 6.0
) -> DataFrame:
    """Fuel after every lap; laps that would start at or below ``reserve`` are left out."""
    out = laps.withColumn("fuel", F.lit(initial) - F.col("LapNumber") * rate)
    return out if reserve is None else out.where(F.col("fuel") + rate > reserve)


def fuel_rate(laps: DataFrame, initial: float = 110.0, target: float = 1.1) -> DataFrame:
    """Fuel per lap with which the race ends at ``target``."""
    return laps.groupBy(*RACE).agg((F.lit(initial - target) / F.max("LapNumber")).alias("rate"))


def fuel_refuel(laps: DataFrame, initial: float = 110.0, rate: float = 3.0, pit_lap: int = 20) -> DataFrame:
    """Fuel with one stop that takes on just what the remaining laps need."""
    total = with_group_stats(laps, RACE, {"_total": F.max("LapNumber")})
    lap = F.col("LapNumber")
    fuel = F.when(lap < pit_lap, F.lit(initial) - (lap + 1) * rate).otherwise((F.col("_total") - lap) * rate)
    return total.withColumn("fuel_refuel", fuel.cast("double")).drop("_total")


def tyre_model(laps: DataFrame, model: dict[str, tuple[float, float, int]] = TYRE_MODEL) -> DataFrame:
    """Modelled lap time of every compound at the lap: base + slope * max(0, lap - knee)."""

    def time(base: float, slope: float, knee: int) -> Column:
        return base + slope * F.greatest(F.lit(0), F.col("LapNumber") - knee)

    return laps.withColumns({f"model_{c.lower()}": time(*p) for c, p in model.items()})
