"""Racing tables derived from the given tables, in Spark and in SQL.

``events`` plays the timing feed: a user is a car, a week is a race weekend, a
user's events in a week are its laps and an ``error`` event is a tyre stop.
Null values are put in by rule so that every operator meets them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlake.functions.ordered import OrderedGroups
from stintlake.session import apply_settings, stage

RACE = ["Year", "GranPrix"]
_EPOCH = 1704067200000000  # 2024-01-01 in microseconds
_WEEK = 604800000000
COMPOUNDS = ["SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET", "HYPERSOFT"]

_cache: dict[tuple[str, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_settings(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table, built once per session and kept in the shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _cache:
        _cache[key] = stage(BUILDERS[name](spark, sf_dir), name)
    return _cache[key]


def _null_every(n: int, col):
    return F.when(F.col("event_id") % n != 0, col)


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with race keys and session time."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    rnd = F.floor((us - _EPOCH) / _WEEK).cast("int") + 1
    return table(spark, sf_dir, "events").select(
        (F.lit(2018) + F.col("user_id") % 7).cast("int").alias("Year"),
        rnd.alias("RoundNumber"),
        F.concat(F.lit("Grand Prix "), rnd.cast("string")).alias("GranPrix"),
        F.col("user_id").alias("DriverNumber"),
        "event_id",
        "event_type",
        "value",
        F.col("ts").cast("timestamp").alias("ts"),
        ((us - _EPOCH - (rnd.cast("long") - 1) * _WEEK) / F.lit(1e6)).alias("Time"),
    )


def build_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    stop = F.col("event_type") == "error"
    car = OrderedGroups(feed(spark, sf_dir), RACE + ["DriverNumber"], ["Time", "event_id"])
    car = car.numbered("LapNumber").frames(
        {
            "LapStartTime": lambda w: F.lag("Time").over(w),
            "_next": lambda w: F.lead("event_type").over(w),
        },
        before=1,
        after=1,
    )
    car = car.running(
        sums={"_stint": stop.cast("long")}, lasts={"_fitted": F.when(stop, F.col("LapNumber"))}
    )
    stint = F.col("_stint") + 1
    age = F.col("LapNumber") - F.coalesce("_fitted", F.lit(1)) + 1 + F.col("DriverNumber") % 3
    compound = F.get(F.array(*map(F.lit, COMPOUNDS)), ((F.col("DriverNumber") + stint) % 6).cast("int"))
    n = F.col("RoundNumber")
    laps = car.result().select(
        *RACE,
        "RoundNumber",
        F.when(n == 4, F.lit("NATION_7 Park"))
        .when(n == 5, F.lit("Unknown Bay"))
        .otherwise(F.concat(F.lit("NATION_"), (n * 3 + F.col("Year") % 3).cast("string")))
        .alias("Location"),
        "DriverNumber",
        F.concat(F.lit("D"), F.col("DriverNumber").cast("string")).alias("Driver"),
        F.concat(F.lit("Team "), (F.col("DriverNumber") % 10).cast("string")).alias("Team"),
        "LapNumber",
        "event_id",
        "Time",
        "LapStartTime",
        _null_every(7, F.col("value")).alias("LapTime"),
        F.when(F.col("_next") == "error", F.col("Time")).alias("PitInTime"),
        F.when(stop, F.col("LapStartTime")).alias("PitOutTime"),
        _null_every(41, stint.cast("int")).alias("Stint"),
        _null_every(29, age.cast("double")).alias("TyreLife"),
        _null_every(53, compound).alias("Compound"),
        F.when(F.col("event_id") % 17 != 0, F.col("event_id") % 3 != 0).alias("FreshTyre"),
        (F.col("event_id") % 11 == 0).alias("IsPersonalBest"),
        (F.col("event_id") % 10 != 0).alias("IsAccurate"),
        (F.floor(F.col("value") * 2) / 8).alias("Sector1Time"),
        (F.floor("value") / 4).alias("Sector2Time"),
        _null_every(31, F.floor(F.col("value") / 2) / 2).alias("Sector3Time"),
    )
    placed = OrderedGroups(laps, RACE + ["LapNumber"], ["Time", "DriverNumber"]).numbered("Position")
    return placed.result().withColumn("Position", _null_every(37, F.col("Position")))


def build_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    return (
        feed(spark, sf_dir)
        .where("event_type = 'view'")
        .select(
            *RACE,
            "Time",
            "event_id",
            _null_every(19, F.col("value") / 4).alias("AirTemp"),
            (F.lit(20) + e % 80).cast("double").alias("Humidity"),
            (F.col("value") / 3).alias("TrackTemp"),
            (F.lit(990) + e % 40).cast("double").alias("Pressure"),
            ((F.col("DriverNumber") % 200) / F.lit(10.0)).alias("WindSpeed"),
            (e * 7 % 360).cast("double").alias("WindDirection"),
            (e % 13 == 0).alias("Rainfall"),
        )
    )


def build_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    cars = (
        role(spark, sf_dir, "laps")
        .groupBy(*RACE, "DriverNumber", "Driver", "Team")
        .agg(
            F.max("LapNumber").alias("Laps"),
            F.max("Time").alias("Time"),
            F.min("LapTime").alias("FastestLap"),
        )
        .withColumn("_less", -F.col("Laps"))
    )
    placed = OrderedGroups(cars, RACE, ["_less", "Time", "DriverNumber"]).numbered("Position")
    return placed.result().select(
        *RACE,
        "DriverNumber",
        F.col("Driver").alias("Abbreviation"),
        F.col("Team").alias("TeamName"),
        F.when(F.col("DriverNumber") % 23 != 0, F.col("Position")).alias("Position"),
        "Laps",
        "Time",
        "FastestLap",
    )


def build_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    return feed(spark, sf_dir).select(
        *RACE,
        F.concat(F.lit("D"), F.col("DriverNumber").cast("string")).alias("Driver"),
        "DriverNumber",
        (F.floor(F.col("Time") / 86400) + 1).cast("int").alias("LapNumber"),
        "event_id",
        "Time",
        F.col("ts").alias("Date"),
        (F.lit(80) + F.floor("value") % 250).cast("double").alias("Speed"),
        (F.lit(5000) + e % 7000).cast("double").alias("RPM"),
        (F.lit(1) + e % 8).cast("int").alias("nGear"),
        (e % 101).cast("double").alias("Throttle"),
        (e * 3 % 101).cast("double").alias("Brake"),
        F.col("event_type").isin("click", "purchase").cast("int").alias("DRS"),
        (F.col("Time") * (F.lit(30) + F.col("DriverNumber") % 10)).alias("Distance"),
        (e * 31 % 1000 - 500).cast("double").alias("X"),
        (e * 17 % 1000 - 500).cast("double").alias("Y"),
    )


def build_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").cast("int").alias("Year"),
        F.month("o_orderdate").cast("int").alias("RoundNumber"),
    )
    n = F.col("RoundNumber")
    return orders.distinct().select(
        "Year",
        "RoundNumber",
        F.concat(F.lit("Grand Prix "), n.cast("string")).alias("EventName"),
        F.concat(F.lit("FORMULA Grand Prix "), n.cast("string")).alias("OfficialEventName"),
        F.concat(F.lit("NATION_"), n.cast("string")).alias("Location"),
        F.when(n % 4 == 0, "sprint").when(n == 1, "testing").otherwise("conventional").alias("EventFormat"),
        F.when(n == 1, F.lit("None")).otherwise(F.lit("Race")).alias("Session5"),
    )


def circuits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("Location"),
        (F.lit(3000) + F.col("n_nationkey") * 137).cast("int").alias("length_m"),
        F.col("n_nationkey").alias("file_order"),
    )


BUILDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "laps": build_laps,
    "weather": build_weather,
    "results": build_results,
    "telemetry": build_telemetry,
    "schedule": build_schedule,
}

# name -> (roles it reads, SELECT)
ROLE_SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "feed": (
        (),
        f"""SELECT CAST(2018 + user_id % 7 AS INTEGER) AS Year, rnd AS RoundNumber,
            'Grand Prix ' || rnd AS GranPrix, user_id AS DriverNumber, event_id, event_type, value, ts,
            (epoch_us(ts) - {_EPOCH} - (CAST(rnd AS BIGINT) - 1) * {_WEEK}) / 1e6 AS Time
        FROM (SELECT *, CAST((epoch_us(ts) - {_EPOCH}) // {_WEEK} AS INTEGER) + 1 AS rnd FROM events)""",
    ),
    "laps": (
        ("feed",),
        """SELECT Year, GranPrix, RoundNumber,
            CASE WHEN RoundNumber = 4 THEN 'NATION_7 Park' WHEN RoundNumber = 5 THEN 'Unknown Bay'
                 ELSE 'NATION_' || (RoundNumber * 3 + Year % 3) END AS Location,
            DriverNumber, 'D' || DriverNumber AS Driver, 'Team ' || (DriverNumber % 10) AS Team,
            LapNumber, event_id, Time, LapStartTime,
            CASE WHEN event_id % 7 <> 0 THEN value END AS LapTime,
            CASE WHEN nxt = 'error' THEN Time END AS PitInTime,
            CASE WHEN event_type = 'error' THEN LapStartTime END AS PitOutTime,
            CASE WHEN event_id % 41 <> 0 THEN CAST(stint AS INTEGER) END AS Stint,
            CASE WHEN event_id % 29 <> 0
                 THEN CAST(LapNumber - coalesce(fitted, 1) + 1 + DriverNumber % 3 AS DOUBLE) END AS TyreLife,
            CASE WHEN event_id % 53 <> 0
                 THEN ['SOFT','MEDIUM','HARD','INTERMEDIATE','WET','HYPERSOFT'][(DriverNumber + stint) % 6 + 1]
                 END AS Compound,
            CASE WHEN event_id % 17 <> 0 THEN event_id % 3 <> 0 END AS FreshTyre,
            event_id % 11 = 0 AS IsPersonalBest, event_id % 10 <> 0 AS IsAccurate,
            floor(value * 2) / 8 AS Sector1Time, floor(value) / 4 AS Sector2Time,
            CASE WHEN event_id % 31 <> 0 THEN floor(value / 2) / 2 END AS Sector3Time,
            CASE WHEN event_id % 37 <> 0 THEN CAST(row_number() OVER
                (PARTITION BY Year, GranPrix, LapNumber ORDER BY Time, DriverNumber) AS INTEGER) END AS Position
        FROM (SELECT *, 1 + count(*) FILTER (event_type = 'error') OVER car AS stint,
                  max(CASE WHEN event_type = 'error' THEN LapNumber END) OVER car AS fitted
              FROM (SELECT *, CAST(row_number() OVER w AS INTEGER) AS LapNumber,
                        lag(Time) OVER w AS LapStartTime, lead(event_type) OVER w AS nxt
                    FROM feed
                    WINDOW w AS (PARTITION BY Year, GranPrix, DriverNumber ORDER BY Time, event_id))
              WINDOW car AS (PARTITION BY Year, GranPrix, DriverNumber ORDER BY LapNumber))""",
    ),
    "weather": (
        ("feed",),
        """SELECT Year, GranPrix, Time, event_id,
            CASE WHEN event_id % 19 <> 0 THEN value / 4 END AS AirTemp,
            CAST(20 + event_id % 80 AS DOUBLE) AS Humidity, value / 3 AS TrackTemp,
            CAST(990 + event_id % 40 AS DOUBLE) AS Pressure, (DriverNumber % 200) / 10.0 AS WindSpeed,
            CAST(event_id * 7 % 360 AS DOUBLE) AS WindDirection, event_id % 13 = 0 AS Rainfall
        FROM feed WHERE event_type = 'view'""",
    ),
    "results": (
        ("laps",),
        """SELECT Year, GranPrix, DriverNumber, Driver AS Abbreviation, Team AS TeamName,
            CASE WHEN DriverNumber % 23 <> 0 THEN CAST(row_number() OVER (PARTITION BY Year, GranPrix
                ORDER BY Laps DESC, Time, DriverNumber) AS INTEGER) END AS Position, Laps, Time, FastestLap
        FROM (SELECT Year, GranPrix, DriverNumber, Driver, Team, max(LapNumber) AS Laps, max(Time) AS Time,
                  min(LapTime) AS FastestLap FROM laps GROUP BY ALL)""",
    ),
    "telemetry": (
        ("feed",),
        """SELECT Year, GranPrix, 'D' || DriverNumber AS Driver, DriverNumber,
            CAST(floor(Time / 86400) + 1 AS INTEGER) AS LapNumber, event_id, Time, ts AS Date,
            CAST(80 + CAST(floor(value) AS BIGINT) % 250 AS DOUBLE) AS Speed,
            CAST(5000 + event_id % 7000 AS DOUBLE) AS RPM, CAST(1 + event_id % 8 AS INTEGER) AS nGear,
            CAST(event_id % 101 AS DOUBLE) AS Throttle, CAST(event_id * 3 % 101 AS DOUBLE) AS Brake,
            CAST(event_type IN ('click', 'purchase') AS INTEGER) AS DRS,
            Time * (30 + DriverNumber % 10) AS Distance,
            CAST(event_id * 31 % 1000 - 500 AS DOUBLE) AS X, CAST(event_id * 17 % 1000 - 500 AS DOUBLE) AS Y
        FROM feed""",
    ),
    "schedule": (
        (),
        """SELECT Year, n AS RoundNumber, 'Grand Prix ' || n AS EventName,
            'FORMULA Grand Prix ' || n AS OfficialEventName, 'NATION_' || n AS Location,
            CASE WHEN n % 4 = 0 THEN 'sprint' WHEN n = 1 THEN 'testing' ELSE 'conventional' END AS EventFormat,
            CASE WHEN n = 1 THEN 'None' ELSE 'Race' END AS Session5
        FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS Year,
                  CAST(month(o_orderdate) AS INTEGER) AS n FROM orders)""",
    ),
    "circuits": (
        (),
        """SELECT n_name AS Location, CAST(3000 + n_nationkey * 137 AS INTEGER) AS length_m,
            n_nationkey AS file_order FROM nation""",
    ),
}
