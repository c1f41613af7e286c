"""Targets and engineered features of the lap dataset.

Groups are ``RaceID`` and ``DriverRaceID``. The car-level features are chained
on one ``OrderedGroups`` so that one exchange and sort serve them all.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from stintlake.functions.joins import join_small
from stintlake.functions.ordered import OrderedGroups, with_group_stats
from stintlake.functions.quantiles import group_quantiles, quantile_struct
from stintlake.operators import laps as L
from stintlake.operators.stints import compound_strategy as _compound_strategy

RACE_ID = ["RaceID"]
CAR_ID = ["DriverRaceID"]
RACE_ORDER = ["DriverRaceID", "LapNumber"]
NO_CHANGE = "NO_CHANGE"

# Which columns are filled in which way.
FFILL = ["TyreLife", "Stint", "Compound"]
INTERPOLATE = ["AirTemp", "TrackTemp", "Humidity", "WindSpeed"]
MEDIAN = ["LapTime", "TimeDeltaToDriverAhead", "TimeDeltaToDriverBehind"]
ZERO = ["tire_degradation_rate", "laptime_trend_3", "delta_ahead_trend"]


def by_car(df: DataFrame) -> OrderedGroups:
    return OrderedGroups(df, CAR_ID, ["LapNumber"])


def by_race(df: DataFrame) -> OrderedGroups:
    return OrderedGroups(df, RACE_ID, RACE_ORDER)


# -- targets ---------------------------------------------------------------


def targets(g: OrderedGroups) -> OrderedGroups:
    """Whether the next lap starts another stint, and on which compound."""

    def change(w: WindowSpec) -> Column:
        following = F.lead("Stint").over(w)
        return (following.isNotNull() & ~F.col("Stint").eqNullSafe(following)).cast("int")

    g = g.frames(
        {"tire_change_next_lap": change, "_next": lambda w: F.lead("Compound").over(w)}, after=1
    )
    kind = F.when(F.col("tire_change_next_lap") == 1, F.col("_next")).otherwise(NO_CHANGE)
    g = g.add({"next_tire_type": kind})
    return g._with(g.df.drop("_next"))


# -- temporal --------------------------------------------------------------


def lap_progress(df: DataFrame) -> DataFrame:
    """Position of the lap between the first and last lap of its race, 0 to 1."""
    stats = with_group_stats(df, RACE_ID, {"_lo": F.min("LapNumber"), "_hi": F.max("LapNumber")})
    return stats.withColumn(
        "lap_progress", F.try_divide(F.col("LapNumber") - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    ).drop("_lo", "_hi")


def stint_progress(df: DataFrame, fit_years: list[int] | None = None) -> DataFrame:
    """Tyre life over the upper quartile of its compound, clipped to 0..2.

    ``fit_years`` limits the rows the quartile is taken from.
    """
    fit = df if fit_years is None else df.where(F.col("Year").isin(fit_years))
    q = group_quantiles(fit, ["Compound"], "TyreLife", {"expected_stint_length": 0.75})
    life, expected = F.col("TyreLife"), F.col("expected_stint_length")
    ratio = F.when((expected == 0) & (life > 0), 2.0).otherwise(F.try_divide(life, expected))
    clipped = F.when(ratio.isNotNull(), F.least(F.greatest(ratio, F.lit(0.0)), F.lit(2.0)))
    return join_small(df, q, ["Compound"]).withColumn("stint_progress", clipped)


# -- performance -----------------------------------------------------------


def _trend3(value: str) -> Callable[[WindowSpec], Column]:
    def expr(w: WindowSpec) -> Column:
        last3 = w.rowsBetween(-2, 0)
        slope = F.regr_slope(F.col(value), F.col("_row").cast("double")).over(last3)
        return F.when(F.count(value).over(last3) >= 2, slope)

    return expr


def rolling_trends(g: OrderedGroups) -> OrderedGroups:
    """Slopes of lap time and of the gap ahead over the last three laps of a car."""
    g = g.numbered("_row").frames(
        {
            "laptime_trend_3": _trend3("LapTime"),
            "delta_ahead_trend": _trend3("TimeDeltaToDriverAhead"),
        },
        before=2,
    )
    return g._with(g.df.drop("_row"))


def degradation_rate(g: OrderedGroups) -> OrderedGroups:
    """Relative lap-time change inside a stint, over missing times; 0 where there is none."""
    stints = g.regroup([*CAR_ID, "Stint"], ["LapNumber"])
    stints = stints.running(lasts={"_time": F.col("LapTime")}).frames(
        {"_before": lambda w: F.lag("_time").over(w)}, before=1
    )
    rate = F.try_divide(F.col("_time"), F.col("_before")) - 1
    known = F.when(F.col("Stint").isNotNull(), rate)
    stints = stints.add({"tire_degradation_rate": F.coalesce(known, F.lit(0.0))})
    return stints._with(stints.df.drop("_time", "_before"))


def compound_age_ratio(df: DataFrame) -> DataFrame:
    """Tyre life over its 90 % quantile in the race and compound; the life itself if that is not positive."""
    keys = [*RACE_ID, "Compound"]
    q = group_quantiles(df, keys, "TyreLife", {"_q90": 0.9})
    life = F.col("TyreLife").cast("double")
    ratio = F.when(F.col("_q90") > 0, life / F.col("_q90")).otherwise(life)
    known = F.when(F.col("Compound").isNotNull(), ratio)
    return join_small(df, q, keys).withColumn("compound_age_ratio", known).drop("_q90")


# -- weather ---------------------------------------------------------------


def weather_stability(df: DataFrame, by: str = "race") -> DataFrame:
    """Sample deviation of the last five rows (three at least), else 0.

    Rows of a race follow one another by car and lap, so by default a frame
    may reach into the car before; ``by="driver"`` keeps cars apart.
    """
    g = by_race(df) if by == "race" else by_car(df)

    def spread(c: str) -> Callable[[WindowSpec], Column]:
        def expr(w: WindowSpec) -> Column:
            last5 = w.rowsBetween(-4, 0)
            std = F.when(F.count(c).over(last5) >= 3, F.stddev_samp(c).over(last5))
            return F.coalesce(std, F.lit(0.0))

        return expr

    return g.frames({f"{c}_stability": spread(c) for c in INTERPOLATE}, before=4).result()


# -- domain knowledge ------------------------------------------------------


def domain_features(df: DataFrame) -> DataFrame:
    return L.likely_stops(L.pit_windows(L.domain_stint(df)))


def compound_strategy(df: DataFrame) -> DataFrame:
    return _compound_strategy(df, CAR_ID)


def readme_features(df: DataFrame) -> DataFrame:
    """The guide's variants: place among the cars of the lap, lap over race laps, pit window by period."""
    cars = with_group_stats(df, [*RACE_ID, "LapNumber"], {"_cars": F.count_distinct("DriverID")})
    laps = with_group_stats(cars, RACE_ID, {"_laps": F.max("LapNumber")})
    return laps.withColumns(
        {
            "position_normalized": F.try_divide(F.col("Position") - 1, F.col("_cars") - 1),
            "race_progress": F.try_divide("LapNumber", "_laps"),
            "in_pit_window": (F.col("LapNumber") % 20).between(15, 20).cast("int"),
        }
    ).drop("_cars", "_laps")


# -- missing values --------------------------------------------------------


def forward_fill(g: OrderedGroups, columns: list[str] = FFILL) -> OrderedGroups:
    return g.running(lasts={c: F.col(c) for c in columns})


def interpolate(g: OrderedGroups, columns: list[str] = INTERPOLATE, limit: int | None = None) -> OrderedGroups:
    """Linear by row between known values; after the last one its value stays.

    ``limit`` is the number of rows filled after a known value. Rows before
    the first known value stay null.
    """
    g = g.numbered("_row")
    point = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"), F.col("_row").alias("i"))) for c in columns}
    g = g.running(
        lasts={f"_p_{c}": point[c] for c in columns}, nexts={f"_n_{c}": point[c] for c in columns}
    )
    row = F.col("_row")
    filled = {}
    for c in columns:
        p, n = F.col(f"_p_{c}"), F.col(f"_n_{c}")
        slope = (n["v"] - p["v"]) / (n["i"] - p["i"])
        value = F.when(p.isNull(), None).when(n.isNull(), p["v"]).otherwise(p["v"] + slope * (row - p["i"]))
        if limit is not None:
            value = F.when(row - p["i"] <= limit, value)
        filled[c] = F.when(F.col(c).isNotNull(), F.col(c)).otherwise(value)
    g = g.add(filled)
    return g._with(g.df.drop("_row", *[f"_{s}_{c}" for s in "pn" for c in columns]))


def fill_median(df: DataFrame, columns: list[str] = MEDIAN) -> DataFrame:
    """Missing values become the median of the whole column."""
    medians = quantile_struct(df, columns, [0.5])
    out = df.withColumn("_m", medians.scalar())
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"_m.{c}_q0")) for c in columns}).drop("_m")


def fill_zero(df: DataFrame, columns: list[str] = ZERO) -> DataFrame:
    return df.fillna(0.0, columns)


def fill_mode(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Missing texts become the most frequent one of the group (the smallest of several), else ``Unknown``."""
    for c in columns:
        counts = df.where(F.col(c).isNotNull()).groupBy(*keys, c).agg(F.count("*").alias("_n"))
        top = counts.groupBy(*keys).agg(F.min(F.struct(-F.col("_n"), F.col(c).alias("v"))).alias("_top"))
        df = (
            join_small(df, top, keys)
            .withColumn(c, F.coalesce(F.col(c), F.col("_top.v"), F.lit("Unknown")))
            .drop("_top")
        )
    return df
