"""Stints, compounds, strategies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.functions import columns as C
from stintlake.functions.joins import join_small
from stintlake.functions.ordered import OrderedGroups, with_group_stats
from stintlake.operators.laps import CAR, RACE

STINT = [*CAR, "Stint", "Compound"]


def stint_length(laps: DataFrame, keys: list[str] = STINT) -> DataFrame:
    """Laps per stint; rows with a null key are left out."""
    return laps.dropna(subset=keys).groupBy(*keys).agg(F.count("LapNumber").alias("LapCount"))


def stint_offset(stints: DataFrame) -> DataFrame:
    """Start lap of every stint bar: the laps of the earlier stints."""
    g = OrderedGroups(stints, CAR, ["Stint", "Compound"])
    return g.running(sums={"StartLap": F.col("LapCount")}, own=False).result()


def stint_last(laps: DataFrame) -> DataFrame:
    """Last lap with tyre life of every stint: how long the tyres lived."""
    fields = [c for c in ("Driver", "Compound", "TyreLife", "TireMeters") if c in laps.columns]
    return (
        laps.where(F.col("TyreLife") > 0)
        .groupBy(*CAR, "Stint")
        .agg(F.max_by(F.struct("LapNumber", *fields), "LapNumber").alias("_last"))
        .select(*CAR, "Stint", "_last.*")
    )


def stint_life_drop(laps: DataFrame) -> DataFrame:
    """Tyre lives found where the tyre distance stops growing, and at the final lap.

    ``laps`` has the whole-metre ``TireMeters`` of ``meters_zero_branch`` and
    its own stint and compound.
    """
    w_cols = {
        "_drop": lambda w: (F.lead("TyreLife").over(w) > 0)
        & (F.lead("TireMeters").over(w) <= F.col("TireMeters")),
        "_final": lambda w: F.lead(F.lit(1)).over(w).isNull() & (F.col("TyreLife") > 0),
    }
    g = OrderedGroups(laps, CAR, ["LapNumber"]).frames(w_cols, after=1)
    return g.result().where(F.col("_drop") | F.col("_final")).drop("_drop", "_final")


def laptime_diff(laps: DataFrame) -> DataFrame:
    """Lap-time change to the previous lap of the same compound and stint; laps without one are dropped."""
    keyed = laps.dropna(subset=["Stint", "Compound"])
    g = OrderedGroups(keyed, STINT, ["LapNumber"]).frames(
        {"LapTimeDelta": lambda w: F.col("LapTime") - F.lag("LapTime").over(w)}, before=1
    )
    return g.result().where(F.col("LapTimeDelta").isNotNull())


def _line(df: DataFrame, keys: list[str], y: str, x: str = "LapNumber") -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(y).alias("n"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
    )


def stint_trend(laps: DataFrame) -> DataFrame:
    """Least-squares line of the lap-time changes of every stint."""
    return _line(laptime_diff(laps), STINT, "LapTimeDelta")


def trend_fit(laps: DataFrame) -> DataFrame:
    """Least-squares line of lap time on lap number per car, with the fitted values."""
    timed = laps.where(F.col("LapTime").isNotNull())
    lines = _line(timed, CAR, "LapTime").drop("n")
    return timed.join(lines, CAR).withColumn(
        "fitted", F.col("intercept") + F.col("slope") * F.col("LapNumber")
    )


def pit_detect(laps: DataFrame, factor: float = 1.5) -> DataFrame:
    """Laps on another compound than the lap before, or slower than ``factor`` times the car's mean."""
    timed = with_group_stats(laps, CAR, {"_mean": F.avg("LapTime")}, few=False)
    g = OrderedGroups(timed, CAR, ["LapNumber"]).frames(
        {
            # a missing compound never equals another one, missing or not
            "_same": lambda w: F.coalesce(F.col("Compound") == F.lag("Compound").over(w), F.lit(False))
        },
        before=1,
    )
    slow = F.coalesce(F.col("LapTime") > F.col("_mean") * factor, F.lit(False))
    return g.result().withColumn("is_pit", ~F.col("_same") | slow).drop("_same", "_mean")


def compound_strategy(laps: DataFrame, keys: list[str] = CAR) -> DataFrame:
    """Compounds in order of first use joined by ``_``, on every lap of the car.

    A missing compound shows as ``None``, as it does in a text conversion.
    """
    name = F.coalesce("Compound", F.lit("None"))
    first = laps.groupBy(*keys, name.alias("_c")).agg(F.min("LapNumber").alias("_at"))
    joined = first.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_at", "_c"))).alias("_used"))
    text = F.array_join(F.transform("_used", lambda u: u["_c"]), "_")
    return laps.join(joined.select(*keys, text.alias("compound_strategy")), keys, "left")


# -- compounds -------------------------------------------------------------


def compound_mean(laps: DataFrame) -> DataFrame:
    return laps.dropna(subset=["Compound"]).groupBy("Compound").agg(F.avg("LapTime").alias("avg_lap_time"))


def compound_degradation(laps: DataFrame) -> DataFrame:
    """Mean lap time and spread per lap; laps without a time count as laps."""
    return laps.dropna(subset=["Compound"]).groupBy("Compound").agg(
        F.avg("LapTime").alias("avg_lap_time"),
        ((F.max("LapTime") - F.min("LapTime")) / F.count("*")).alias("degradation_rate"),
    )


def strategy_cost(strategies: DataFrame, compounds: DataFrame) -> DataFrame:
    """Total time of strategies of ``(compound, laps)`` stints; one with an unknown compound is left out."""
    known = compounds.select(F.col("Compound").alias("compound"), "avg_lap_time")
    parts = join_small(strategies.select("strategy_id", F.inline("stints")), known, ["compound"])
    return (
        parts.groupBy("strategy_id")
        .agg(
            F.sum(F.col("avg_lap_time") * F.col("laps")).alias("total_time"),
            F.bool_and(F.col("avg_lap_time").isNotNull()).alias("_known"),
        )
        .where("_known")
        .drop("_known")
    )


def strategy_cost_default(strategies: DataFrame, compounds: DataFrame) -> DataFrame:
    """The same with default lap times for unknown compounds."""
    known = compounds.select(F.col("Compound").alias("compound"), "avg_lap_time")
    parts = join_small(strategies.select("strategy_id", F.inline("stints")), known, ["compound"])
    default = C.lookup("compound", C.DEFAULT_LAP_TIME, C.DEFAULT_LAP_TIME_OTHER)
    time = F.coalesce("avg_lap_time", default)
    return parts.groupBy("strategy_id").agg(F.sum(time * F.col("laps")).alias("total_time"))


# -- distances -------------------------------------------------------------


def max_distance(laps: DataFrame) -> DataFrame:
    """Longest race distance and tyre distance per year, and overall with a null year."""
    return laps.rollup("Year").agg(
        F.max("DriverMeters").alias("max_race_distance"), F.max("TireMeters").alias("max_tyre_meters")
    )


def global_norm(df: DataFrame, columns: list[str], fixed: dict[str, float] | None = None) -> DataFrame:
    """``Normalized<c>``: columns divided by their maximum over the whole table, 0 when that is 0."""
    fixed = fixed or {}
    top = df.agg(F.struct(*[F.max(c).cast("double").alias(c) for c in columns]).alias("_top"))
    out = df.withColumn("_top", top.scalar())

    def part(c):
        m = F.col(f"_top.{c}")
        return F.when(m > 0, F.col(c) / m).otherwise(0.0)

    return out.withColumns(
        {f"Normalized{c}": part(c) for c in columns}
        | {f"Normalized{c}": F.col(c) / v for c, v in fixed.items()}
    ).drop("_top")


# -- counts and results ----------------------------------------------------


def total_laps(laps: DataFrame) -> DataFrame:
    return laps.groupBy(*RACE).agg(F.max("LapNumber").alias("total_laps"))


def fastest_lap(laps: DataFrame, keys: list[str] = CAR) -> DataFrame:
    """Fastest lap per car or session, the first on equal times."""
    timed = laps.where(F.col("LapTime").isNotNull())
    others = [c for c in ("Driver", "DriverNumber", "Compound") if c in laps.columns and c not in keys]
    first = F.struct("LapTime", "LapNumber", *others)
    return timed.groupBy(*keys).agg(F.min(first).alias("_f")).select(*keys, "_f.*")


def average_finish(season: DataFrame) -> DataFrame:
    """Mean finishing position per driver and year, without missing and zero positions."""
    placed = F.when(F.col("position") != 0, F.col("position"))
    return season.groupBy("driver", "year").agg(F.avg(placed).alias("avg_finish"))


def pit_duration(laps: DataFrame, paired: bool = False) -> DataFrame:
    """Mean pit time per car: lap end minus pit entry, or with ``paired`` the
    exit on the next lap minus the entry."""
    if paired:
        g = OrderedGroups(laps, CAR, ["LapNumber"]).frames(
            {"_until": lambda w: F.lead("PitOutTime").over(w)}, after=1
        )
        laps, until = g.result(), F.col("_until")
    else:
        until = F.col("Time")
    return laps.groupBy(*CAR).agg(F.avg(until - F.col("PitInTime")).alias("pit_duration"))


def position_series(laps: DataFrame) -> DataFrame:
    """Position by lap for drawing, with a running number per car."""
    placed = laps.where(F.col("Position").isNotNull()).select(*CAR, "Driver", "LapNumber", "Position")
    return OrderedGroups(placed, CAR, ["LapNumber"]).numbered("n").result()


def laptime_distribution(quick: DataFrame, results: DataFrame, top: int = 10) -> DataFrame:
    """Lap counts by whole second for the first ``top`` finishers of every race, by compound."""
    first = results.where(F.col("Position") <= top).select(*CAR, F.col("Position").alias("Finish"))
    return (
        quick.where(F.col("LapTime").isNotNull())
        .join(first, CAR)
        .groupBy(*CAR, "Finish", "Compound", F.floor("LapTime").alias("second"))
        .agg(F.count("*").alias("laps"))
    )
