"""Weather joined to laps."""

from pyspark.sql import functions as F

from stintlake.catalog.registry import R, query, r6
from stintlake.catalog.roles import role
from stintlake.operators import laps as L
from stintlake.operators import weather as W

ID = ["Year", "GranPrix", "DriverNumber", "LapNumber"]
IDS = ", ".join(ID)
MEASURES = W.MEASURES


def _rounded(df, *more):
    return df.select(*ID, *[r6(c).alias(c) for c in MEASURES], "Rainfall", *more)


_MEANS = ", ".join(f"avg(w.{c}) AS {c}" for c in MEASURES)
RANGE_SQL = f"""inside AS (SELECT l.Year, l.GranPrix, l.DriverNumber, l.LapNumber, count(w.Time) AS n, {_MEANS},
        bool_or(w.Rainfall) AS Rainfall,
        {", ".join(f"arg_max_null(w.{c}, struct_pack(t := w.Time, e := w.event_id)) AS last_{c}" for c in [*MEASURES, "Rainfall"])}
    FROM laps l LEFT JOIN weather w ON w.Year = l.Year AND w.GranPrix = l.GranPrix
        AND w.Time >= l.LapStartTime AND w.Time <= l.Time
    GROUP BY ALL),
    near AS (SELECT l.Year, l.GranPrix, l.DriverNumber, l.LapNumber, w.* EXCLUDE (Year, GranPrix, Time, event_id)
    FROM laps l JOIN weather w ON w.Year = l.Year AND w.GranPrix = l.GranPrix
    WHERE l.LapStartTime IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY l.Year, l.GranPrix, l.DriverNumber, l.LapNumber
        ORDER BY abs(w.Time - l.LapStartTime), w.Time, w.event_id) = 1)"""


def _avg_sql(rain: str) -> str:
    cols = ", ".join(R(f"CASE WHEN i.n > 0 THEN i.{c} ELSE near.{c} END") + f" AS {c}" for c in MEASURES)
    return f"""{RANGE_SQL} SELECT {IDS}, {cols}, {rain} AS Rainfall
        FROM inside i LEFT JOIN near USING ({IDS})"""


_RAIN = "CASE WHEN i.n > 0 THEN i.Rainfall ELSE near.Rainfall END"


@query("join_weather_avg", _avg_sql(_RAIN), ("laps", "weather"))
def join_weather_avg(spark, sf):
    return _rounded(W.join_weather_avg(role(spark, sf, "laps"), role(spark, sf, "weather"), tie="event_id"))


@query("join_weather_avg_v2", _avg_sql(f"coalesce({_RAIN}, false)"), ("laps", "weather"))
def join_weather_avg_v2(spark, sf):
    laps, weather = role(spark, sf, "laps"), role(spark, sf, "weather")
    return _rounded(W.join_weather_avg(laps, weather, rain_unknown=False, tie="event_id"))


@query(
    "join_weather_mean_only",
    f"""{RANGE_SQL} SELECT {IDS}, {", ".join(R(c) + f" AS {c}" for c in MEASURES)}, Rainfall,
        {R("AirTemp / 61")} AS NormalizedAirTemp, {R("TrackTemp / 61")} AS NormalizedTrackTemp FROM inside""",
    ("laps", "weather"),
)
def join_weather_mean_only(spark, sf):
    laps, weather = role(spark, sf, "laps"), role(spark, sf, "weather")
    done = L.fixed_norm(W.join_weather_avg(laps, weather, nearest=False, tie="event_id"))
    return _rounded(
        done,
        r6("NormalizedAirTemp").alias("NormalizedAirTemp"),
        r6("NormalizedTrackTemp").alias("NormalizedTrackTemp"),
    )


@query(
    "join_weather_last_over_n",
    f"""{RANGE_SQL} SELECT {IDS}, {", ".join(R(f"last_{c} / nullif(n, 0)") + f" AS {c}" for c in MEASURES)},
        CAST(last_Rainfall AS INTEGER) AS Rainfall FROM inside""",
    ("laps", "weather"),
)
def join_weather_last_over_n(spark, sf):
    laps, weather = role(spark, sf, "laps"), role(spark, sf, "weather")
    return _rounded(W.join_weather_last_over_n(laps, weather, tie="event_id"))


@query(
    "join_lap_weather_nearest",
    f"""{RANGE_SQL} SELECT {IDS}, CAST(near.Rainfall AS INTEGER) AS Rainfall, {R("near.TrackTemp")} AS TrackTemp,
        Sector1Time, Sector2Time, Sector3Time FROM laps LEFT JOIN near USING ({IDS})""",
    ("laps", "weather"),
)
def join_lap_weather_nearest(spark, sf):
    done = W.join_lap_weather_nearest(role(spark, sf, "laps"), role(spark, sf, "weather"), tie="event_id")
    sectors = [f"Sector{i}Time" for i in (1, 2, 3)]
    return done.select(*ID, "Rainfall", r6("TrackTemp").alias("TrackTemp"), *sectors)


@query(
    "agg_track_temp_series",
    f"""ev AS (SELECT DISTINCT 2017 + Year % 7 AS Year, EventName AS GranPrix FROM schedule WHERE EventFormat = 'conventional')
    SELECT Year, GranPrix, Time, {R("TrackTemp")} AS TrackTemp FROM weather SEMI JOIN ev USING (Year, GranPrix)
    ORDER BY Year, GranPrix, Time""",
    ("weather", "schedule"),
)
def agg_track_temp_series(spark, sf):
    # the orders calendar is moved onto the years of the timing feed
    schedule = role(spark, sf, "schedule").withColumn("Year", F.lit(2017) + F.col("Year") % 7)
    done = W.track_temp_series(role(spark, sf, "weather"), schedule)
    return done.withColumn("TrackTemp", r6("TrackTemp"))
