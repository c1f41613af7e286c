"""Cars around a car: by position, by finishing order and by sector."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from stintlake.functions.columns import floor_half_second
from stintlake.functions.ordered import OrderedGroups
from stintlake.operators.laps import CAR, RACE, pick_accurate, pick_quicklaps

LAP = [*RACE, "LapNumber"]


def place_neighbours(
    df: DataFrame, keys: list[str], place: str, payload: list[str], step: int = 1
) -> DataFrame:
    """Per group and place, structs ``ahead`` and ``behind`` of the rows one ``step`` away.

    Several rows at one place count as the first of them by ``payload``. Rows
    are aggregated per place first, so the keys of both shuffles are
    ``(keys, place)`` and no group is gathered.
    """
    at = df.where(F.col(place).isNotNull()).groupBy(*keys, F.col(place).alias("_at")).agg(
        F.min(F.struct(*payload)).alias("_row")
    )
    sides = F.array(
        F.struct((F.col("_at") + step).alias("_at"), F.lit(True).alias("_is_ahead")),
        F.struct((F.col("_at") - step).alias("_at"), F.lit(False).alias("_is_ahead")),
    )
    return (
        at.select(*keys, "_row", F.explode(sides).alias("_side"))
        .groupBy(*keys, F.col("_side._at").alias(place))
        .agg(
            F.max(F.when(F.col("_side._is_ahead"), F.col("_row"))).alias("ahead"),
            F.max(F.when(~F.col("_side._is_ahead"), F.col("_row"))).alias("behind"),
        )
    )


def join_neighbours_exact(laps: DataFrame, signed: bool = False) -> DataFrame:
    """Cars one position ahead and behind on the same lap, with the lap-time difference.

    Differences are absolute; ``signed`` gives own minus ahead and behind minus own.
    """
    near = place_neighbours(laps, LAP, "Position", ["DriverNumber", "Driver", "LapTime"])
    out = laps.join(near, [*LAP, "Position"], "left")
    ahead = F.col("LapTime") - F.col("ahead.LapTime")
    behind = F.col("behind.LapTime") - F.col("LapTime")
    if not signed:
        ahead, behind = F.abs(ahead), F.abs(behind)
    return out.withColumns(
        {
            "DriverAhead": F.col("ahead.Driver"),
            "DriverBehind": F.col("behind.Driver"),
            "DiffToAhead": ahead,
            "DiffToBehind": behind,
        }
    ).drop("ahead", "behind")


def join_neighbours_nearest(laps: DataFrame) -> DataFrame:
    """The next occupied positions ahead and behind on the same lap, gaps allowed."""
    at = laps.where(F.col("Position").isNotNull()).groupBy(*LAP, "Position").agg(
        F.min(F.struct("DriverNumber", "Driver")).alias("_row")
    )
    near = OrderedGroups(at, LAP, ["Position"]).frames(
        {
            "PreviousDriver": lambda w: F.lag("_row.Driver").over(w),
            "NextDriver": lambda w: F.lead("_row.Driver").over(w),
        },
        before=1,
        after=1,
    )
    return laps.join(near.result().drop("_row"), [*LAP, "Position"], "left")


def time_deltas(
    laps: DataFrame, car: str = "DriverNumber", drop_untimed: bool = False
) -> DataFrame:
    """Gaps in session time to the cars one and two places ahead and behind on the same lap.

    A missing neighbour at either end of the order counts as a gap of 0; a car
    or neighbour without a time gives null. With ``drop_untimed`` cars without
    a time are passed over, and a lap with a single car stays null.
    """
    ranked = F.col("Position").isNotNull()
    if drop_untimed:
        ranked = ranked & F.col("Time").isNotNull()
    g = OrderedGroups(laps.withColumn("_ranked", ranked), [*LAP, "_ranked"], ["Position", car])

    def gap(offset: int):
        def expr(w: WindowSpec) -> Column:
            other = F.lag(F.struct("Time"), offset).over(w)
            diff = F.col("Time") - other["Time"] if offset > 0 else other["Time"] - F.col("Time")
            value = F.when(other.isNull(), 0.0).otherwise(diff)
            known = F.col("_ranked") & F.col("Time").isNotNull()
            if drop_untimed:
                alone = F.lag(F.lit(1), 1).over(w).isNull() & F.lead(F.lit(1), 1).over(w).isNull()
                known = known & ~alone
            return F.when(known, value)

        return expr

    done = g.frames(
        {
            "TimeDeltaToDriverAhead": gap(1),
            "TimeDeltaToDriverTwoAhead": gap(2),
            "TimeDeltaToDriverBehind": gap(-1),
            "TimeDeltaToDriverTwoBehind": gap(-2),
        },
        before=2,
        after=2,
    )
    return done.result().drop("_ranked")


def adjacent_finishers(results: DataFrame) -> DataFrame:
    """For every classified car: itself and the cars one final position ahead and behind."""
    who = ["DriverNumber", "Abbreviation", "TeamName"]
    near = place_neighbours(results, RACE, "Position", who)
    placed = results.where(F.col("Position").isNotNull()).join(near, [*RACE, "Position"], "left")

    def part(role: str, position: Column, row: str | None) -> Column:
        fields = [F.col(f"{row}.{c}" if row else c).alias(c) for c in who]
        return F.struct(F.lit(role).alias("role"), position.alias("Position"), *fields)

    p = F.col("Position")
    roles = F.array(
        part("target", p, None),
        F.when(F.col("ahead").isNotNull(), part("ahead", p - 1, "ahead")),
        F.when(F.col("behind").isNotNull(), part("behind", p + 1, "behind")),
    )
    return placed.select(
        *RACE, F.col("DriverNumber").alias("target"), F.explode(F.array_compact(roles)).alias("_r")
    ).select(*RACE, "target", "_r.*")


def compare_outer(laps: DataFrame, trio: DataFrame) -> DataFrame:
    """One row per target and lap with lap time and team of the target and its neighbours."""
    both = trio.select(*CAR, "target", "role").join(laps.select(*CAR, "LapNumber", "LapTime", "Team"), CAR)
    roles = ("target", "ahead", "behind")
    return both.groupBy(*RACE, "target", "LapNumber").agg(
        *[F.max(F.when(F.col("role") == r, F.col("LapTime"))).alias(f"LapTime_{r}") for r in roles],
        *[F.max(F.when(F.col("role") == r, F.col("Team"))).alias(f"Team_{r}") for r in roles],
    )


def average_gap(laps: DataFrame, trio: DataFrame, threshold: float = 1.07) -> DataFrame:
    """Mean lap-time difference to a neighbour over common quick and accurate laps.

    ``ahead`` holds a positive mean (the other car is slower), ``behind`` the
    size of a negative one.
    """
    quick = pick_accurate(pick_quicklaps(laps, threshold)).select(*CAR, "LapNumber", "LapTime")
    pairs = trio.where(F.col("role") != "target").select(
        *RACE, F.col("target").alias("DriverNumber"), "role", F.col("DriverNumber").alias("other")
    )
    own = quick.join(pairs, CAR)
    theirs = quick.select(
        *RACE, F.col("DriverNumber").alias("other"), "LapNumber", F.col("LapTime").alias("_theirs")
    )
    gaps = (
        own.join(theirs, [*RACE, "other", "LapNumber"])
        .groupBy(*CAR, "role", "other")
        .agg(F.avg(F.col("_theirs") - F.col("LapTime")).alias("_gap"))
    )
    g = F.col("_gap")
    return gaps.select(*CAR, "role", "other", F.when(g > 0, g).alias("ahead"), F.when(g < 0, -g).alias("behind"))


def common_laps(laps: DataFrame, first: str, second: str) -> DataFrame:
    """Laps that two drivers both drove, per race."""
    one = laps.where(F.col("Driver") == first).select(*LAP)
    two = laps.where(F.col("Driver") == second).select(*LAP)
    return one.intersect(two)


# -- sectors ---------------------------------------------------------------


def sector_laps(laps: DataFrame, sectors: int = 3) -> DataFrame:
    """One row per lap and timed sector."""
    names = [f"Sector{i}Time" for i in range(1, sectors + 1)]
    session = [f"Sector{i}SessionTime" for i in range(1, sectors + 1)]
    parts = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("Sector"),
                F.col(names[i]).alias("SectorTime"),
                (F.col(session[i]) if session[i] in laps.columns else F.lit(None).cast("double")).alias(
                    "SectorSessionTime"
                ),
            )
            for i in range(sectors)
        ]
    )
    return (
        laps.select(*RACE, "DriverNumber", "LapNumber", F.explode(parts).alias("_s"))
        .select(*RACE, "DriverNumber", "LapNumber", "_s.*")
        .where(F.col("SectorTime").isNotNull())
    )


def average_rank(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Ascending rank inside the group; equal values share the mean of their ranks."""
    return OrderedGroups(df, keys, [value]).ranked(name, "_peers").result().drop("_peers")


SECTOR = [*RACE, "LapNumber", "Sector"]


def sector_rank(sectors: DataFrame) -> DataFrame:
    return average_rank(sectors, SECTOR, "SectorTime", "Position")


def sector_neighbours(sectors: DataFrame) -> DataFrame:
    """Rank in the sector of a lap, and the cars one rank ahead and behind with time deltas, in one ordered pass.

    Ranks are means over cars with equal times, so two cars are one rank apart only if neither shares its time.
    """
    g = OrderedGroups(sectors, SECTOR, ["SectorTime", "DriverNumber"]).ranked("Position", "_peers")
    car = F.struct("DriverNumber", "SectorTime", "_peers")
    g = g.frames({"_ahead": lambda w: F.lag(car).over(w), "_behind": lambda w: F.lead(car).over(w)}, before=1, after=1)

    def near(side: str, field: str) -> Column:
        alone = (F.col("_peers") == 1) & (F.col(f"{side}._peers") == 1)
        return F.when(alone, F.col(f"{side}.{field}"))

    own = F.col("SectorTime")
    return (
        g.result()
        .withColumns(
            {
                "DriverAhead": near("_ahead", "DriverNumber"),
                "TimeAhead": near("_ahead", "SectorTime"),
                "DriverBehind": near("_behind", "DriverNumber"),
                "TimeBehind": near("_behind", "SectorTime"),
                "DeltaToAhead": own - near("_ahead", "SectorTime"),
                "DeltaToBehind": own - near("_behind", "SectorTime"),
                "HalfSecondTimestamp": floor_half_second("SectorSessionTime"),
            }
        )
        .drop("_peers", "_ahead", "_behind")
    )
