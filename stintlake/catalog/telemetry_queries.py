"""Telemetry, time alignment, drawing and scenarios."""

from pyspark.sql import functions as F

from stintlake.catalog.registry import R, query, r6
from stintlake.catalog.roles import role, table
from stintlake.operators import scenario as S
from stintlake.operators import telemetry as T

STEP = 21600.0  # the roles' races last a week, so the grid is one point in six hours
DRIVEN = "Year, GranPrix, Driver, LapNumber"


_FASTEST = """fast AS (SELECT Year, GranPrix, Driver, LapNumber FROM laps WHERE LapTime IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY Year, GranPrix, Driver ORDER BY LapTime, LapNumber) = 1)"""


@query(
    "join_fastest_telemetry",
    f"""{_FASTEST} SELECT t.Year, t.GranPrix, t.Driver, t.LapNumber, t.Time, t.Distance, t.Speed, t.Throttle, t.Brake, t.RPM,
        CAST(t.nGear AS DOUBLE) AS nGear FROM telemetry t SEMI JOIN fast USING ({DRIVEN})""",
    ("laps", "telemetry"),
)
def join_fastest_telemetry(spark, sf):
    return T.trace(role(spark, sf, "telemetry"), T.fastest_laps(role(spark, sf, "laps")))


@query(
    "prj_telemetry_trace",
    f"""{_FASTEST}, t AS (SELECT * FROM telemetry SEMI JOIN fast USING ({DRIVEN}))
    SELECT {DRIVEN}, Time, Distance, c AS channel, CASE c WHEN 'Speed' THEN Speed WHEN 'Throttle' THEN Throttle
        WHEN 'Brake' THEN Brake WHEN 'RPM' THEN RPM ELSE nGear END AS value
    FROM t, (SELECT unnest(['Speed', 'Throttle', 'Brake', 'RPM', 'nGear']) AS c)""",
    ("laps", "telemetry"),
)
def prj_telemetry_trace(spark, sf):
    return T.trace(role(spark, sf, "telemetry"), T.fastest_laps(role(spark, sf, "laps")), long=True)


@query(
    "agg_peak_instants",
    f"""SELECT {DRIVEN}, arg_min(Time, struct_pack(v := -Brake, t := Time)) AS Brake_peak_time,
        arg_min(Time, struct_pack(v := -Throttle, t := Time)) AS Throttle_peak_time FROM telemetry GROUP BY ALL""",
    ("telemetry",),
)
def agg_peak_instants(spark, sf):
    return T.peak_instants(role(spark, sf, "telemetry"))


@query(
    "win_cum_distance",
    f"""s AS (SELECT *, Speed / 3.6::DOUBLE * (Time - coalesce(lag(Time) OVER (PARTITION BY {DRIVEN} ORDER BY Time, event_id), 0)) AS step
        FROM telemetry)
    SELECT event_id, round(sum(step) OVER (PARTITION BY {DRIVEN} ORDER BY Time, event_id) + 3e-9, 3) AS CumDistance FROM s""",
    ("telemetry",),
)
def win_cum_distance(spark, sf):
    done = T.cumulative_distance(role(spark, sf, "telemetry"))
    return done.select("event_id", F.round(F.col("CumDistance") + 3e-9, 3).alias("CumDistance"))


def _nearest(name: str, table_name: str, time: str, values: str, tie: str, keys: str) -> str:
    on = " AND ".join(f"s.{k} = g.{k}" for k in keys.split(", "))
    return f"""{name} AS (SELECT g.Year, g.GranPrix, g.Driver, g.t, {values} FROM grid g JOIN {table_name} s ON {on}
        WHERE s.{time} IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY g.Year, g.GranPrix, g.Driver, g.t ORDER BY abs(s.{time} - g.t), s.{time}, s.{tie}) = 1)"""


GRID_SQL = f"""ends AS (SELECT Year, GranPrix, max(Time) AS e FROM weather GROUP BY ALL),
    cars AS (SELECT DISTINCT Year, GranPrix, Driver FROM laps),
    grid AS (SELECT Year, GranPrix, Driver, unnest(range(CAST(floor(e / {STEP}) AS BIGINT) + 1)) * {STEP}::DOUBLE AS t
        FROM cars JOIN ends USING (Year, GranPrix)),
    {_nearest("tele", "telemetry", "Time", "s.Speed, s.Distance", "event_id", "Year, GranPrix, Driver")},
    {_nearest("lend", "laps", "Time", "s.Position", "LapNumber", "Year, GranPrix, Driver")},
    {_nearest("lstart", "laps", "LapStartTime", "s.LapNumber, s.Compound", "LapNumber", "Year, GranPrix, Driver")},
    {_nearest("wea", "weather", "Time", "s.TrackTemp, s.AirTemp, s.Rainfall", "event_id", "Year, GranPrix")},
    seen AS (SELECT g.*, printf('%02d:%02d', CAST(t AS BIGINT) // 60, CAST(t AS BIGINT) % 60) AS clock, Speed, Distance, Position,
        LapNumber, Compound, TrackTemp, AirTemp, CAST(coalesce(Rainfall, false) AS INTEGER) AS Rain
    FROM grid g LEFT JOIN tele USING (Year, GranPrix, Driver, t) LEFT JOIN lend USING (Year, GranPrix, Driver, t)
    LEFT JOIN lstart USING (Year, GranPrix, Driver, t) LEFT JOIN wea USING (Year, GranPrix, Driver, t))"""


GRID_SQL0 = GRID_SQL.replace("seen AS", "seen0 AS")


def _view(spark, sf):
    return T.grid_view(
        role(spark, sf, "laps"), role(spark, sf, "telemetry"), role(spark, sf, "weather"), STEP, tie="event_id"
    )


@query("join_asof_nearest", f"{GRID_SQL} SELECT * FROM seen", ("laps", "telemetry", "weather"))
def join_asof_nearest(spark, sf):
    return _view(spark, sf)


def _gap_sql(place: str) -> str:
    return f"""spots AS (SELECT Year, GranPrix, t, {place} AS p, arg_min(Distance, Driver) AS d FROM seen
        WHERE {place} IS NOT NULL GROUP BY ALL)
    SELECT v.Year, v.GranPrix, v.Driver, v.t, v.{place} AS place, {R("coalesce(v.Distance - a.d, 0)")} AS GapAhead,
        {R("coalesce(b.d - v.Distance, 0)")} AS GapBehind
    FROM seen v LEFT JOIN spots a ON a.Year = v.Year AND a.GranPrix = v.GranPrix AND a.t = v.t AND a.p = v.{place} - 1
    LEFT JOIN spots b ON b.Year = v.Year AND b.GranPrix = v.GranPrix AND b.t = v.t AND b.p = v.{place} + 1"""


def _gaps(view, place):
    done = T.gap_metres(view, place)
    return done.select(
        "Year", "GranPrix", "Driver", "t", F.col(place).alias("place"), r6("GapAhead").alias("GapAhead"), r6("GapBehind").alias("GapBehind")
    )


@query(
    "join_gap_metres",
    f"{GRID_SQL}, {_gap_sql('Position')}",
    ("laps", "telemetry", "weather"),
)
def join_gap_metres(spark, sf):
    return _gaps(_view(spark, sf), "Position")


@query(
    "join_gap_metres_first_lap",
    f"""{GRID_SQL0}, firsts AS (SELECT Year, GranPrix, Driver, arg_min_null(Position, LapNumber) AS FirstPosition
        FROM laps GROUP BY ALL), seen AS (SELECT * FROM seen0 JOIN firsts USING (Year, GranPrix, Driver)), {_gap_sql('FirstPosition')}""",
    ("laps", "telemetry", "weather"),
)
def join_gap_metres_first_lap(spark, sf):
    return _gaps(T.with_first_place(_view(spark, sf), role(spark, sf, "laps")), "FirstPosition")



# -- half seconds ------------------------------------------------------------

# the roles' weeks as races of half an hour, so that a grid of half seconds has about as many points as a race's
HALF, SHORT = 0.5, 336.0
_OFF = 1.3e-5  # added before rounding, so that exact halves round the same way
_SHORT_SQL = f"""l AS (SELECT * REPLACE (Time / {SHORT}::DOUBLE AS Time, LapStartTime / {SHORT}::DOUBLE AS LapStartTime) FROM laps),
    te AS (SELECT * REPLACE (Time / {SHORT}::DOUBLE AS Time) FROM telemetry),
    we AS (SELECT * REPLACE (Time / {SHORT}::DOUBLE AS Time) FROM weather),
    ends AS (SELECT Year, GranPrix, max(Time) AS e FROM we GROUP BY ALL),
    cars AS (SELECT DISTINCT Year, GranPrix, Driver FROM l),
    ticks AS (SELECT Year, GranPrix, unnest(range(CAST(floor(e / {HALF}) AS BIGINT) + 1)) * {HALF}::DOUBLE AS t FROM ends),
    grid AS (SELECT Year, GranPrix, Driver, t FROM cars JOIN ticks USING (Year, GranPrix))"""


def _asof(name: str, table_name: str, time: str, values: list[str], tie: str, car: bool = True) -> str:
    """The nearest sample to every point, by one ASOF join to either side."""
    keys = ["Year", "GranPrix"] + (["Driver"] if car else [])
    points = "grid" if car else "ticks"
    cols = ", ".join(values)
    on = " AND ".join(f"s.{k} = g.{k}" for k in keys)
    picked = ", ".join(f"CASE WHEN b.{time} IS NULL OR (a.{time} - p.t) < (p.t - b.{time}) THEN a.{v} ELSE b.{v} END AS {v}" for v in values)
    match = lambda o: " AND ".join(f"{o}.{k} = p.{k}" for k in keys + ["t"])
    side = lambda op: f"SELECT {', '.join(f'g.{k}' for k in keys)}, g.t, s.{time}, {', '.join('s.' + v for v in values)} FROM {points} g ASOF JOIN {name}_s s ON {on} AND g.t {op} s.{time}"
    return f"""{name}_s AS (SELECT {", ".join(keys)}, {time}, {cols} FROM {table_name} WHERE {time} IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY {", ".join(keys)}, {time} ORDER BY {tie}) = 1),
    {name}_b AS ({side(">=")}), {name}_a AS ({side("<=")}),
    {name} AS (SELECT {", ".join(f"p.{k}" for k in keys)}, p.t, {picked}
        FROM {points} p LEFT JOIN {name}_b b ON {match("b")} LEFT JOIN {name}_a a ON {match("a")})"""


def _short(spark, sf):
    laps = role(spark, sf, "laps").withColumns({c: F.col(c) / SHORT for c in ("Time", "LapStartTime")})
    return laps, *[role(spark, sf, n).withColumn("Time", F.col("Time") / SHORT) for n in ("telemetry", "weather")]


@query(
    "join_asof_half_second",
    f"""{_SHORT_SQL}, {_asof("tele", "te", "Time", ["Speed", "Distance"], "event_id")},
    {_asof("lend", "l", "Time", ["Position"], "LapNumber")}, {_asof("lstart", "l", "LapStartTime", ["LapNumber", "Compound"], "LapNumber")},
    {_asof("wea", "we", "Time", ["TrackTemp", "AirTemp", "Rainfall"], "event_id", car=False)}
    SELECT Year, GranPrix, Driver, LapNumber, Compound, Position, count(*) AS points, min(t) AS first_t, max(t) AS last_t,
        round(avg(Speed) + {_OFF}, 3) AS speed, max(Distance) AS distance, round(avg(TrackTemp) + {_OFF}, 3) AS track_temp, round(avg(AirTemp) + {_OFF}, 3) AS air_temp,
        count(*) FILTER (Rainfall) AS rain_points
    FROM grid LEFT JOIN tele USING (Year, GranPrix, Driver, t) LEFT JOIN lend USING (Year, GranPrix, Driver, t)
    LEFT JOIN lstart USING (Year, GranPrix, Driver, t) LEFT JOIN wea USING (Year, GranPrix, t) GROUP BY ALL""",
    ("laps", "telemetry", "weather"),
)
def join_asof_half_second(spark, sf):
    """What is nearest to every half second, summed up by lap and place without making the points."""
    seen = T.grid_sums(*_short(spark, sf), HALF, tie="event_id")
    means = {"speed": "Speed", "track_temp": "TrackTemp", "air_temp": "AirTemp"}
    return seen.select(
        "Year",
        "GranPrix",
        "Driver",
        "LapNumber",
        "Compound",
        "Position",
        "points",
        (F.col("from") * HALF).alias("first_t"),
        (F.col("upto") * HALF).alias("last_t"),
        F.col("Distance").alias("distance"),
        *[F.round(F.col(c) + _OFF, 3).alias(n) for n, c in means.items()],
        "rain_points",
    )


def _half_gap_sql(place: str, joined: str) -> str:
    return f"""{_SHORT_SQL}, {_asof("tele", "te", "Time", ["Distance"], "event_id")}, {_asof("lend", "l", "Time", ["Position"], "LapNumber")},
    firsts AS (SELECT Year, GranPrix, Driver, arg_min_null(Position, LapNumber) AS FirstPosition FROM l GROUP BY ALL),
    seen AS (SELECT Year, GranPrix, Driver, t, Distance, {place} AS p FROM grid LEFT JOIN tele USING (Year, GranPrix, Driver, t) {joined}),
    spots AS (SELECT Year, GranPrix, t, p, arg_min(Distance, Driver) AS d FROM seen WHERE p IS NOT NULL GROUP BY ALL)
    SELECT v.Year, v.GranPrix, v.Driver, v.p AS place, count(*) AS points, round(avg(coalesce(v.Distance - a.d, 0)) + {_OFF}, 3) AS gap_ahead,
        round(avg(coalesce(b.d - v.Distance, 0)) + {_OFF}, 3) AS gap_behind, {R("max(abs(coalesce(v.Distance - a.d, 0)))")} AS most_ahead
    FROM seen v LEFT JOIN spots a ON a.Year = v.Year AND a.GranPrix = v.GranPrix AND a.t = v.t AND a.p = v.p - 1
    LEFT JOIN spots b ON b.Year = v.Year AND b.GranPrix = v.GranPrix AND b.t = v.t AND b.p = v.p + 1 GROUP BY ALL"""


def _half_gaps(spark, sf, first_lap):
    """Mean and largest gaps of every car by place, over all half seconds."""
    gaps = T.gap_stretches(*_short(spark, sf), HALF, tie="event_id", first_lap=first_lap)
    n = F.col("until") - F.col("from")
    return gaps.groupBy("Year", "GranPrix", "Driver", "place").agg(
        F.sum(n).alias("points"),
        F.round(F.sum(F.col("GapAhead") * n) / F.sum(n) + _OFF, 3).alias("gap_ahead"),
        F.round(F.sum(F.col("GapBehind") * n) / F.sum(n) + _OFF, 3).alias("gap_behind"),
        r6(F.max(F.abs("GapAhead"))).alias("most_ahead"),
    )


@query(
    "join_gap_metres_half_second",
    _half_gap_sql("Position", "LEFT JOIN lend USING (Year, GranPrix, Driver, t)"),
    ("laps", "telemetry", "weather"),
)
def join_gap_metres_half_second(spark, sf):
    return _half_gaps(spark, sf, False)


@query(
    "join_gap_metres_half_second_first_lap",
    _half_gap_sql("FirstPosition", "JOIN firsts USING (Year, GranPrix, Driver)"),
    ("laps", "telemetry", "weather"),
)
def join_gap_metres_half_second_first_lap(spark, sf):
    return _half_gaps(spark, sf, True)


@query(
    "join_asof_backward",
    """SELECT t.event_id, l.LapNumber AS LapInProgress, l.Position AS LapPosition FROM telemetry t
    ASOF LEFT JOIN (SELECT * FROM laps WHERE LapStartTime IS NOT NULL) l
        ON t.Year = l.Year AND t.GranPrix = l.GranPrix AND t.Driver = l.Driver AND t.Time >= l.LapStartTime""",
    ("laps", "telemetry"),
)
def join_asof_backward(spark, sf):
    done = T.lap_in_progress(role(spark, sf, "telemetry"), role(spark, sf, "laps"))
    return done.select("event_id", "LapInProgress", "LapPosition")


@query("flt_drs_open", "SELECT event_id FROM telemetry WHERE DRS = 1", ("telemetry",))
def flt_drs_open(spark, sf):
    return T.drs_open(role(spark, sf, "telemetry")).select("event_id")


ZONE_SQL = f"""z AS (SELECT *, CAST(sum(CAST(DRS = 1 AND coalesce(prev, 0) <> 1 AS INTEGER)) OVER
        (PARTITION BY {DRIVEN} ORDER BY Time, event_id) AS BIGINT) AS zone
    FROM (SELECT *, lag(DRS) OVER (PARTITION BY {DRIVEN} ORDER BY Time, event_id) AS prev FROM telemetry)),
    points AS (SELECT * FROM z WHERE DRS = 1)"""


@query(
    "win_drs_zones",
    f'{ZONE_SQL} SELECT {DRIVEN}, zone, min(Distance) AS start, max(Distance) AS "end", count(*) AS points FROM points GROUP BY ALL',
    ("telemetry",),
)
def win_drs_zones(spark, sf):
    return T.drs_zones(T.drs_points(role(spark, sf, "telemetry")))


@query("win_drs_points", f"{ZONE_SQL} SELECT event_id, zone, X, Y FROM points", ("telemetry",))
def win_drs_points(spark, sf):
    return T.drs_points(role(spark, sf, "telemetry")).select("event_id", "zone", "X", "Y")


@query(
    "win_segments",
    f"""SELECT event_id, X, Y, lead(X) OVER w AS X_end, lead(Y) OVER w AS Y_end, nGear, Speed,
        {R(f'coalesce((Speed - min(Speed) OVER (PARTITION BY {DRIVEN})) / nullif(max(Speed) OVER (PARTITION BY {DRIVEN}) - min(Speed) OVER (PARTITION BY {DRIVEN}), 0), 0)')} AS SpeedScaled
    FROM telemetry WINDOW w AS (PARTITION BY {DRIVEN} ORDER BY Time, event_id) QUALIFY lead(1) OVER w IS NOT NULL""",
    ("telemetry",),
)
def win_segments(spark, sf):
    done = T.segments(role(spark, sf, "telemetry"))
    return done.select("event_id", "X", "Y", "X_end", "Y_end", "nGear", "Speed", r6("SpeedScaled").alias("SpeedScaled"))


@query(
    "prj_rotate",
    f"""r AS (SELECT *, radians((DriverNumber % 36) * 10) AS a FROM telemetry)
    SELECT event_id, {R("X * cos(a) - Y * sin(a)")} AS X_rot, {R("X * sin(a) + Y * cos(a)")} AS Y_rot FROM r""",
    ("telemetry",),
)
def prj_rotate(spark, sf):
    points = role(spark, sf, "telemetry").withColumn("rotation", (F.col("DriverNumber") % 36) * 10)
    return T.rotated_track(points).select("event_id", r6("X_rot").alias("X_rot"), r6("Y_rot").alias("Y_rot"))


@query(
    "prj_corner_marks",
    f"""c AS (SELECT s_suppkey AS Number, chr(CAST(65 + s_suppkey % 26 AS INTEGER)) AS Letter, s_acctbal AS X, s_acctbal / 2 AS Y,
        radians(s_suppkey * 7 % 360) AS a, radians(s_nationkey * 10) AS t FROM supplier),
    o AS (SELECT *, X + 500 * cos(a) AS ox, Y + 500 * sin(a) AS oy FROM c)
    SELECT Number, Number || Letter AS label, {R("ox * cos(t) - oy * sin(t)")} AS text_x, {R("ox * sin(t) + oy * cos(t)")} AS text_y,
        {R("X * cos(t) - Y * sin(t)")} AS track_x, {R("X * sin(t) + Y * cos(t)")} AS track_y FROM o""",
    (),
)
def prj_corner_marks(spark, sf):
    corners = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("Number"),
        F.char((F.lit(65) + F.col("s_suppkey") % 26).cast("int")).alias("Letter"),
        F.col("s_acctbal").alias("X"),
        (F.col("s_acctbal") / 2).alias("Y"),
        (F.col("s_suppkey") * 7 % 360).cast("double").alias("Angle"),
        (F.col("s_nationkey") * 10).cast("double").alias("rotation"),
    )
    done = T.corner_marks(corners)
    return done.select("Number", "label", *[r6(c).alias(c) for c in ("text_x", "text_y", "track_x", "track_y")])


# -- scenarios -------------------------------------------------------------


@query(
    "scn_fuel_remaining",
    "SELECT event_id, 110.0::DOUBLE - LapNumber * 3.0::DOUBLE AS fuel FROM laps WHERE 110.0 - (LapNumber - 1) * 3.0 > 6",
)
def scn_fuel_remaining(spark, sf):
    return S.fuel_remaining(role(spark, sf, "laps")).select("event_id", "fuel")


@query("scn_fuel_rate", f"SELECT Year, GranPrix, {R('108.9 / max(LapNumber)')} AS rate FROM laps GROUP BY ALL")
def scn_fuel_rate(spark, sf):
    return S.fuel_rate(role(spark, sf, "laps")).withColumn("rate", r6("rate"))


@query(
    "scn_fuel_refuel",
    """SELECT event_id, CAST(CASE WHEN LapNumber < 8 THEN 110.0 - (LapNumber + 1) * 3.0
        ELSE (max(LapNumber) OVER (PARTITION BY Year, GranPrix) - LapNumber) * 3.0 END AS DOUBLE) AS fuel_refuel FROM laps""",
)
def scn_fuel_refuel(spark, sf):
    return S.fuel_refuel(role(spark, sf, "laps"), pit_lap=8).select("event_id", "fuel_refuel")


@query(
    "scn_tyre_model",
    f"""SELECT event_id, {R("90 + 0.5 * greatest(0, LapNumber - 10)")} AS model_soft,
        {R("91 + 0.3 * greatest(0, LapNumber - 15)")} AS model_medium FROM laps""",
)
def scn_tyre_model(spark, sf):
    done = S.tyre_model(role(spark, sf, "laps"))
    return done.select("event_id", r6("model_soft").alias("model_soft"), r6("model_medium").alias("model_medium"))
