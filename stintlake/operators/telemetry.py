"""Car telemetry: traces, alignment on a time grid, DRS zones, track drawing.

Rows are kept by race and car; a race alone is never a key of raw telemetry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlake.functions import steps
from stintlake.functions.asof import Samples, align
from stintlake.functions.columns import lap_percentage, minutes_seconds, rotated
from stintlake.functions.joins import join_small
from stintlake.functions.ordered import OrderedGroups, with_group_stats
from stintlake.operators.laps import RACE
from stintlake.session import stage

DRIVEN = [*RACE, "Driver", "LapNumber"]
CHANNELS = ["Speed", "Throttle", "Brake", "RPM", "nGear", "Steering"]


# -- traces ----------------------------------------------------------------


def trace(telemetry: DataFrame, laps: DataFrame, long: bool = False) -> DataFrame:
    """Channels along the distance for the given laps, wide or as (channel, value) rows."""
    channels = [c for c in CHANNELS if c in telemetry.columns]
    rows = telemetry.join(laps.select(*DRIVEN), DRIVEN, "left_semi").select(
        *DRIVEN, "Time", "Distance", *[F.col(c).cast("double").alias(c) for c in channels]
    )
    if not long:
        return rows
    return rows.unpivot([*DRIVEN, "Time", "Distance"], channels, "channel", "value")


def fastest_laps(laps: DataFrame, drivers: list[str] | None = None) -> DataFrame:
    """Race, driver and number of every car's fastest lap."""
    chosen = laps if drivers is None else laps.where(F.col("Driver").isin(drivers))
    return (
        chosen.where(F.col("LapTime").isNotNull())
        .groupBy(*RACE, "Driver")
        .agg(F.min(F.struct("LapTime", "LapNumber")).alias("_f"))
        .select(*RACE, "Driver", F.col("_f.LapNumber").alias("LapNumber"))
    )


def peak_instants(telemetry: DataFrame, channels: tuple[str, ...] = ("Brake", "Throttle")) -> DataFrame:
    """Per lap the first time at which a channel is at its largest."""
    return telemetry.groupBy(*DRIVEN).agg(
        *[F.min_by("Time", F.struct(-F.col(c), "Time")).alias(f"{c}_peak_time") for c in channels]
    )


def cumulative_distance(telemetry: DataFrame, keys: list[str] = DRIVEN, tie: str = "event_id") -> DataFrame:
    """Metres driven since the start of the group, by speed and time steps."""
    g = OrderedGroups(telemetry, keys, ["Time", tie]).frames({"_before": lambda w: F.lag("Time").over(w)}, before=1)
    step = F.col("Speed") / 3.6 * (F.col("Time") - F.coalesce("_before", F.lit(0.0)))
    # decimals add up alike in any order, so cuts in a group do not show in the last digits
    rows = g.running(sums={"CumDistance": step.cast("decimal(24,9)")}).result()
    return rows.drop("_before").withColumn("CumDistance", F.col("CumDistance").cast("double"))


# -- alignment -------------------------------------------------------------

RUN = 7200  # points of one run of the grid, so that a long race is no single array


def time_grid(cars: DataFrame, ends: DataFrame, step: float = 0.5) -> DataFrame:
    """Every car at every ``step`` seconds from 0 to the end of its race, made in runs of ``RUN`` points."""
    spans = join_small(cars.select(*RACE, "Driver").distinct(), ends.select(*RACE, "end"), RACE, "inner")
    last = F.floor(F.col("end") / step).cast("long")
    runs = F.sequence(F.lit(0).cast("long"), last, F.lit(RUN).cast("long"))
    spans = spans.where("end >= 0").select(*RACE, "Driver", last.alias("last"), F.explode(runs).alias("run"))
    ticks = F.sequence("run", F.least("last", F.col("run") + (RUN - 1)))
    return spans.select(*RACE, "Driver", F.explode(ticks).alias("tick")).select(
        *RACE, "Driver", (F.col("tick") * step).alias("t")
    )


def race_ends(weather: DataFrame) -> DataFrame:
    return weather.groupBy(*RACE).agg(F.max("Time").alias("end"))


def grid_view(
    laps: DataFrame, telemetry: DataFrame, weather: DataFrame, step: float = 0.5, tie: str | None = None
) -> DataFrame:
    """Weather, telemetry, position and lap nearest to every point of the time grid."""
    grid = time_grid(laps, race_ends(weather), step)
    car = align(
        grid,
        [*RACE, "Driver"],
        "t",
        ["t"],
        {
            "telemetry": Samples(telemetry, "Time", ["Speed", "Distance"], tie),
            "lap_end": Samples(laps, "Time", ["Position"], "LapNumber"),
            "lap_start": Samples(laps, "LapStartTime", ["LapNumber", "Compound"], "LapNumber"),
        },
    )
    both = align(car, RACE, "t", ["Driver"], {"weather": Samples(weather, "Time", ["TrackTemp", "AirTemp", "Rainfall"], tie)})
    return both.select(
        *RACE,
        "Driver",
        "t",
        minutes_seconds("t").alias("clock"),
        F.col("telemetry.Speed").alias("Speed"),
        F.col("telemetry.Distance").alias("Distance"),
        F.col("lap_end.Position").alias("Position"),
        F.col("lap_start.LapNumber").alias("LapNumber"),
        F.col("lap_start.Compound").alias("Compound"),
        F.col("weather.TrackTemp").alias("TrackTemp"),
        F.col("weather.AirTemp").alias("AirTemp"),
        F.coalesce("weather.Rainfall", F.lit(False)).cast("int").alias("Rain"),
    )


def gap_metres(view: DataFrame, by: str = "Position", length: Column | None = None) -> DataFrame:
    """Distance to the cars one place ahead and behind at the same grid time, 0 without one.

    ``view`` is joined with itself, so it is staged first. Cars sharing a place count as the first of them by name.
    """
    keys = [*RACE, "t"]
    view = stage(view, "grid")
    at = view.where(F.col(by).isNotNull()).groupBy(*keys, F.col(by).alias("_at")).agg(
        F.min(F.struct("Driver", "Distance")).alias("_row")
    )
    sides = F.array(
        F.struct((F.col("_at") + 1).alias(by), F.lit(True).alias("ahead")),
        F.struct((F.col("_at") - 1).alias(by), F.lit(False).alias("ahead")),
    )
    near = (
        at.select(*keys, F.col("_row.Distance").alias("_d"), F.explode(sides).alias("_s"))
        .groupBy(*keys, F.col(f"_s.{by}").alias(by))
        .agg(
            F.max(F.when(F.col("_s.ahead"), F.col("_d"))).alias("_ahead"),
            F.max(F.when(~F.col("_s.ahead"), F.col("_d"))).alias("_behind"),
        )
    )
    out = view.join(near, [*keys, by], "left").withColumns(
        {
            "GapAhead": F.coalesce(F.col("Distance") - F.col("_ahead"), F.lit(0.0)),
            "GapBehind": F.coalesce(F.col("_behind") - F.col("Distance"), F.lit(0.0)),
        }
    )
    if length is not None:
        out = out.withColumn("LapPercentage", lap_percentage("Distance", length))
    return out.drop("_ahead", "_behind")


def _car_base(laps: DataFrame, weather: DataFrame, step: float) -> DataFrame:
    """Every car of a race with the last tick of the race, that of the last weather sample."""
    cars = laps.select(*RACE, "Driver").distinct()
    spans = join_small(cars, race_ends(weather), RACE, "inner").where("end >= 0")
    return stage(spans.select(*RACE, "Driver", F.floor(F.col("end") / step).cast("long").alias("last")), "cars")


def grid_stretches(
    laps: DataFrame, telemetry: DataFrame, weather: DataFrame, step: float = 0.5, tie: str | None = None
) -> DataFrame:
    """``grid_view`` by stretches of the grid: ``from`` and ``until`` ticks and what is nearest in between.

    ``stretch_view`` makes the points of it. The work grows with the samples (a race's weather counts for each of its
    cars), not with the points.
    """
    base = _car_base(laps, weather, step)
    sky = weather.select(*RACE, "Time", "TrackTemp", "AirTemp", "Rainfall", *([tie] if tie else []))
    by_car = sky.join(base.select(*RACE, "Driver"), RACE)
    found = steps.nearest_steps(
        base,
        [*RACE, "Driver"],
        {
            "telemetry": Samples(telemetry, "Time", ["Speed", "Distance"], tie),
            "lap_end": Samples(laps, "Time", ["Position"], "LapNumber"),
            "lap_start": Samples(laps, "LapStartTime", ["LapNumber", "Compound"], "LapNumber"),
            "weather": Samples(by_car, "Time", ["TrackTemp", "AirTemp", "Rainfall"], tie),
        },
        step,
    )
    return found.select(
        *RACE,
        "Driver",
        "from",
        "until",
        "telemetry.Speed",
        "telemetry.Distance",
        "lap_end.Position",
        "lap_start.LapNumber",
        "lap_start.Compound",
        "weather.TrackTemp",
        "weather.AirTemp",
        F.coalesce("weather.Rainfall", F.lit(False)).cast("int").alias("Rain"),
    )


def grid_sums(
    laps: DataFrame, telemetry: DataFrame, weather: DataFrame, step: float = 0.5, tie: str | None = None
) -> DataFrame:
    """``grid_stretches`` summed up by car, lap, compound and place, without a race's weather for each of its cars.

    Gives ``points``, the first and last tick ``from`` and ``upto``, ``Distance`` (the largest), means over the points of
    ``Speed, TrackTemp, AirTemp``, and ``rain_points``. The weather of a race is one row of stretches with exact running
    totals, which a car's stretches look up at both ends, so the work grows with samples and cars, not with their product.
    """
    base, car = _car_base(laps, weather, step), [*RACE, "Driver"]
    found = steps.nearest_steps(
        base,
        car,
        {
            "telemetry": Samples(telemetry, "Time", ["Speed", "Distance"], tie),
            "lap_end": Samples(laps, "Time", ["Position"], "LapNumber"),
            "lap_start": Samples(laps, "LapStartTime", ["LapNumber", "Compound"], "LapNumber"),
        },
        step,
    )
    groups = ["lap_start.LapNumber", "lap_start.Compound", "lap_end.Position", "telemetry.Speed", "telemetry.Distance"]
    driven = found.select(*car, "from", "until", *groups)
    races = base.select(*RACE, "last").distinct()
    sky = {"weather": Samples(weather, "Time", ["TrackTemp", "AirTemp", "Rainfall"], tie)}
    sky = steps.nearest_steps(races, RACE, sky, step).select(*RACE, "from", "until", "weather.*")
    sky = sky.withColumn("Rainfall", F.coalesce("Rainfall", F.lit(False)).cast("int"))
    rows = steps.with_sums(driven, sky, RACE, ["TrackTemp", "AirTemp"], ["Rainfall"])
    n = F.col("until") - F.col("from")
    parts = rows.groupBy(*car, "LapNumber", "Compound", "Position").agg(
        F.sum(n).alias("points"),
        F.min("from").alias("from"),
        (F.max("until") - 1).alias("upto"),
        F.max("Distance").alias("Distance"),
        F.try_divide(F.sum(F.col("Speed") * n), F.sum(F.when(F.col("Speed").isNotNull(), n))).alias("Speed"),
        *steps.added(rows, ["TrackTemp", "AirTemp"], ["Rainfall"]),
    )
    return steps.averaged(parts, ["TrackTemp", "AirTemp"]).withColumnRenamed("Rainfall", "rain_points")


def stretch_view(stretches: DataFrame, step: float = 0.5) -> DataFrame:
    """The points of ``grid_stretches``: the rows of ``grid_view``."""
    made = steps.points(stretches, step)
    return made.withColumn("clock", minutes_seconds("t"))


def gap_stretches(
    laps: DataFrame,
    telemetry: DataFrame,
    weather: DataFrame,
    step: float = 0.5,
    tie: str | None = None,
    first_lap: bool = False,
) -> DataFrame:
    """Distance to the cars one place ahead and behind by stretches of the grid: ``place, Distance, GapAhead, GapBehind``.

    Places change at few ticks. The holder of a place between two changes (the first by name of several) is found first,
    then every car's neighbours by stretch, then their distances, and all of it is laid over the car's own. A gap is 0
    where the neighbour or a distance is missing. ``first_lap`` takes the places of the first lap for the whole race.
    """
    base, car = _car_base(laps, weather, step), [*RACE, "Driver"]
    if first_lap:
        first = laps.groupBy(*car).agg(F.min_by("Position", "LapNumber").alias("place"))
        places = base.join(first, car).select(*car, F.lit(0).cast("long").alias("from"), (F.col("last") + 1).alias("until"), "place")
    else:
        places = steps.nearest_steps(base, car, {"lap_end": Samples(laps, "Time", ["Position"], "LapNumber")}, step)
        places = places.select(*car, "from", "until", F.col("lap_end.Position").alias("place"))
    places = stage(places.where("place is not null"), "places")
    driven = steps.nearest_steps(base, car, {"telemetry": Samples(telemetry, "Time", ["Distance"], tie)}, step)
    driven = stage(driven.select(*car, "from", "until", "telemetry.Distance"), "driven")
    holders = steps.first_of(places, [*RACE, "place"], "Driver").withColumnRenamed("Driver", "holder")
    sides = F.array(*[F.struct(F.lit(up).alias("ahead"), (F.col("place") + by).alias("at")) for up, by in ((True, -1), (False, 1))])
    asked = places.withColumn("_s", F.explode(sides)).select(*car, "from", "until", F.col("_s.ahead").alias("ahead"), F.col("_s.at").alias("place"))
    near = steps.overlaps(asked, holders, [*RACE, "place"]).drop("place")
    theirs = driven.select(*RACE, F.col("Driver").alias("holder"), "from", "until", F.col("Distance").alias("there"))
    apart = stage(steps.overlaps(near, theirs, [*RACE, "holder"]).drop("holder"), "apart")
    found = steps.merged(
        base,
        car,
        {
            "place": (places, "place"),
            "Distance": (driven, "Distance"),
            "ahead": (apart.where("ahead"), "there"),
            "behind": (apart.where("not ahead"), "there"),
        },
    )
    return found.select(
        *car,
        "from",
        "until",
        "place",
        "Distance",
        F.coalesce(F.col("Distance") - F.col("ahead"), F.lit(0.0)).alias("GapAhead"),
        F.coalesce(F.col("behind") - F.col("Distance"), F.lit(0.0)).alias("GapBehind"),
    )


def with_first_place(view: DataFrame, laps: DataFrame, name: str = "FirstPosition") -> DataFrame:
    """Every car's position on its first lap, for gaps by starting order."""
    first = laps.groupBy(*RACE, "Driver").agg(F.min_by("Position", "LapNumber").alias(name))
    return view.join(first, [*RACE, "Driver"], "left")


def lap_in_progress(points: DataFrame, laps: DataFrame, time: str = "Time", point_id: str = "event_id") -> DataFrame:
    """The lap under way at a time: the last one started at or before it."""
    found = align(
        points,
        [*RACE, "Driver"],
        time,
        [point_id],
        {"lap": Samples(laps, "LapStartTime", ["LapNumber", "Position"], "LapNumber")},
        "backward",
    )
    return found.withColumns(
        {"LapInProgress": F.col("lap.LapNumber"), "LapPosition": F.col("lap.Position")}
    ).drop("lap")


# -- DRS -------------------------------------------------------------------


def drs_open(telemetry: DataFrame, codes: tuple[int, ...] = (1,)) -> DataFrame:
    return telemetry.where(F.col("DRS").isin(*codes))


def drs_points(telemetry: DataFrame, codes: tuple[int, ...] = (1,), tie: str = "event_id") -> DataFrame:
    """Rows with open DRS, numbered by the zone of consecutive rows they belong to."""
    is_open = F.coalesce(F.col("DRS").isin(*codes), F.lit(False))
    g = OrderedGroups(telemetry, DRIVEN, ["Time", tie])
    g = g.add({"_open": is_open}).frames(
        {"_starts": lambda w: F.col("_open") & ~F.coalesce(F.lag("_open").over(w), F.lit(False))}, before=1
    )
    g = g.running(sums={"zone": F.col("_starts").cast("long")})
    return g.result().where("_open").drop("_open", "_starts")


def drs_zones(points: DataFrame) -> DataFrame:
    return points.groupBy(*DRIVEN, "zone").agg(
        F.min("Distance").alias("start"), F.max("Distance").alias("end"), F.count("*").alias("points")
    )


# -- drawing ---------------------------------------------------------------


def segments(telemetry: DataFrame, tie: str = "event_id") -> DataFrame:
    """Pairs of consecutive track points with gear, speed and the speed scaled over the lap."""
    scaled = with_group_stats(telemetry, DRIVEN, {"_lo": F.min("Speed"), "_hi": F.max("Speed")}, few=False)
    g = OrderedGroups(scaled, DRIVEN, ["Time", tie]).frames(
        {"X_end": lambda w: F.lead("X").over(w), "Y_end": lambda w: F.lead("Y").over(w), "_more": lambda w: F.lead(F.lit(1)).over(w)},
        after=1,
    )
    share = F.try_divide(F.col("Speed") - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    return (
        g.result()
        .where(F.col("_more").isNotNull())
        .withColumn("SpeedScaled", F.coalesce(share, F.lit(0.0)))
        .drop("_more", "_lo", "_hi")
    )


def rotated_track(points: DataFrame, degrees: str = "rotation") -> DataFrame:
    x, y = rotated("X", "Y", F.radians(degrees))
    return points.withColumns({"X_rot": x, "Y_rot": y})


def corner_marks(corners: DataFrame, offset: float = 500.0) -> DataFrame:
    """Corner labels with the turned positions of the corner and of its text beside the track."""
    off_x, off_y = rotated(F.lit(offset), F.lit(0.0), F.radians("Angle"))
    track = F.radians("rotation")
    text_x, text_y = rotated(F.col("X") + off_x, F.col("Y") + off_y, track)
    mark_x, mark_y = rotated("X", "Y", track)
    return corners.withColumns(
        {
            "label": F.concat(F.col("Number").cast("string"), F.coalesce("Letter", F.lit(""))),
            "text_x": text_x,
            "text_y": text_y,
            "track_x": mark_x,
            "track_y": mark_y,
        }
    )
