"""Neighbours by position, finish and sector."""

from pyspark.sql import functions as F

from stintlake.catalog.registry import R, query, r6
from stintlake.catalog.roles import role
from stintlake.operators import neighbours as N

ID = ["Year", "GranPrix", "DriverNumber", "LapNumber"]
IDS = ", ".join(ID)


def _at(offset: int, alias: str) -> str:
    return f"""LEFT JOIN spot {alias} ON {alias}.Year = l.Year AND {alias}.GranPrix = l.GranPrix
        AND {alias}.LapNumber = l.LapNumber AND {alias}.Position = l.Position + ({offset})"""


_AT = """spot AS (SELECT * FROM laps WHERE Position IS NOT NULL QUALIFY row_number() OVER
    (PARTITION BY Year, GranPrix, LapNumber, Position ORDER BY DriverNumber) = 1)"""


def _exact_sql(ahead: str, behind: str) -> str:
    return f"""{_AT} SELECT l.Year, l.GranPrix, l.DriverNumber, l.LapNumber, a.Driver AS DriverAhead,
        b.Driver AS DriverBehind, {R(ahead)} AS DiffToAhead, {R(behind)} AS DiffToBehind
        FROM laps l {_at(-1, "a")} {_at(1, "b")}"""


def _near(df):
    return df.select(
        *ID, "DriverAhead", "DriverBehind", r6("DiffToAhead").alias("DiffToAhead"), r6("DiffToBehind").alias("DiffToBehind")
    )


@query("join_neighbours_exact", _exact_sql("abs(l.LapTime - a.LapTime)", "abs(b.LapTime - l.LapTime)"))
def join_neighbours_exact(spark, sf):
    return _near(N.join_neighbours_exact(role(spark, sf, "laps")))


@query("join_neighbours_signed", _exact_sql("l.LapTime - a.LapTime", "b.LapTime - l.LapTime"))
def join_neighbours_signed(spark, sf):
    return _near(N.join_neighbours_exact(role(spark, sf, "laps"), signed=True))


@query(
    "join_neighbours_nearest",
    f"""{_AT}, n AS (SELECT Year, GranPrix, LapNumber, Position, lag(Driver) OVER w AS PreviousDriver,
        lead(Driver) OVER w AS NextDriver FROM spot
        WINDOW w AS (PARTITION BY Year, GranPrix, LapNumber ORDER BY Position))
    SELECT {IDS}, PreviousDriver, NextDriver FROM laps LEFT JOIN n USING (Year, GranPrix, LapNumber, Position)""",
)
def join_neighbours_nearest(spark, sf):
    return N.join_neighbours_nearest(role(spark, sf, "laps")).select(*ID, "PreviousDriver", "NextDriver")


GAPS = [
    "TimeDeltaToDriverAhead",
    "TimeDeltaToDriverTwoAhead",
    "TimeDeltaToDriverBehind",
    "TimeDeltaToDriverTwoBehind",
]
DELTAS_SQL = f"""deltas AS (SELECT *,
        CASE WHEN Time IS NULL THEN NULL WHEN i <= 1 THEN 0.0 ELSE Time - lag(Time, 1) OVER w END AS {GAPS[0]},
        CASE WHEN Time IS NULL THEN NULL WHEN i <= 2 THEN 0.0 ELSE Time - lag(Time, 2) OVER w END AS {GAPS[1]},
        CASE WHEN Time IS NULL THEN NULL WHEN i > n - 1 THEN 0.0 ELSE lead(Time, 1) OVER w - Time END AS {GAPS[2]},
        CASE WHEN Time IS NULL THEN NULL WHEN i > n - 2 THEN 0.0 ELSE lead(Time, 2) OVER w - Time END AS {GAPS[3]}
    FROM (SELECT *, row_number() OVER (PARTITION BY Year, GranPrix, LapNumber ORDER BY Position) AS i,
              count(*) OVER (PARTITION BY Year, GranPrix, LapNumber) AS n FROM placed)
    WINDOW w AS (PARTITION BY Year, GranPrix, LapNumber ORDER BY Position))"""
_GAP_LIST = ", ".join(R(c) + f" AS {c}" for c in GAPS)


def _gaps(df):
    return df.select(*ID, *[r6(c).alias(c) for c in GAPS])


@query(
    "win_time_deltas",
    f"""placed AS (SELECT * REPLACE (CASE WHEN event_id % 43 <> 0 THEN Time END AS Time) FROM laps
        WHERE Position IS NOT NULL), {DELTAS_SQL}
    SELECT {IDS}, {_GAP_LIST} FROM laps LEFT JOIN deltas USING ({IDS})""",
)
def win_time_deltas(spark, sf):
    return _gaps(N.time_deltas(_untimed(role(spark, sf, "laps"))))


@query(
    "win_time_deltas_v2",
    f"""placed AS (SELECT * FROM laps WHERE Position IS NOT NULL AND event_id % 43 <> 0
        QUALIFY count(*) OVER (PARTITION BY Year, GranPrix, LapNumber) > 1), {DELTAS_SQL}
    SELECT {IDS}, {_GAP_LIST} FROM laps LEFT JOIN deltas USING ({IDS})""",
)
def win_time_deltas_v2(spark, sf):
    return _gaps(N.time_deltas(_untimed(role(spark, sf, "laps")), drop_untimed=True))


def _untimed(laps):
    return laps.withColumn("Time", F.when(F.col("event_id") % 43 != 0, F.col("Time")))


TRIO_SQL = """one AS (SELECT * FROM results WHERE Position IS NOT NULL),
    trio AS (SELECT t.Year, t.GranPrix, t.DriverNumber AS target,
        CASE o.Position - t.Position WHEN 0 THEN 'target' WHEN -1 THEN 'ahead' ELSE 'behind' END AS role,
        o.Position, o.DriverNumber, o.Abbreviation, o.TeamName
    FROM one t JOIN one o ON t.Year = o.Year AND t.GranPrix = o.GranPrix AND abs(o.Position - t.Position) <= 1)"""


@query("join_adjacent_finishers", f"{TRIO_SQL} SELECT * FROM trio", ("laps", "results"))
def join_adjacent_finishers(spark, sf):
    return N.adjacent_finishers(role(spark, sf, "results"))


@query(
    "join_compare_outer",
    f"""{TRIO_SQL} SELECT Year, GranPrix, target, LapNumber,
        max(LapTime) FILTER (role = 'target') AS LapTime_target, max(LapTime) FILTER (role = 'ahead') AS LapTime_ahead,
        max(LapTime) FILTER (role = 'behind') AS LapTime_behind, max(Team) FILTER (role = 'target') AS Team_target,
        max(Team) FILTER (role = 'ahead') AS Team_ahead, max(Team) FILTER (role = 'behind') AS Team_behind
    FROM trio JOIN laps USING (Year, GranPrix, DriverNumber) GROUP BY ALL""",
    ("laps", "results"),
)
def join_compare_outer(spark, sf):
    trio = N.adjacent_finishers(role(spark, sf, "results"))
    return N.compare_outer(role(spark, sf, "laps"), trio)


@query(
    "join_avg_gap",
    f"""{TRIO_SQL}, q AS (SELECT * FROM (SELECT *, min(LapTime) OVER (PARTITION BY Year, GranPrix) AS best FROM laps)
        WHERE IsAccurate AND LapTime < 8 * best),
    g AS (SELECT a.Year, a.GranPrix, t.target AS DriverNumber, role, t.DriverNumber AS other,
        avg(b.LapTime - a.LapTime) AS gap
    FROM trio t JOIN q a ON a.Year = t.Year AND a.GranPrix = t.GranPrix AND a.DriverNumber = t.target
    JOIN q b ON b.Year = t.Year AND b.GranPrix = t.GranPrix AND b.DriverNumber = t.DriverNumber
        AND a.LapNumber = b.LapNumber
    WHERE role <> 'target' GROUP BY ALL)
    SELECT Year, GranPrix, DriverNumber, role, other, {R("CASE WHEN gap > 0 THEN gap END")} AS ahead,
        {R("CASE WHEN gap < 0 THEN -gap END")} AS behind FROM g""",
    ("laps", "results"),
)
def join_avg_gap(spark, sf):
    trio = N.adjacent_finishers(role(spark, sf, "results"))
    done = N.average_gap(role(spark, sf, "laps"), trio, 8.0)
    return done.select(
        "Year", "GranPrix", "DriverNumber", "role", "other", r6("ahead").alias("ahead"), r6("behind").alias("behind")
    )


SECTOR_SQL = """sec AS (SELECT Year, GranPrix, DriverNumber, LapNumber, s AS Sector,
        CASE s WHEN 1 THEN Sector1Time WHEN 2 THEN Sector2Time ELSE Sector3Time END AS SectorTime
    FROM laps, (SELECT unnest([1, 2, 3]) AS s)),
    ranked AS (SELECT *, rank() OVER w + (count(*) OVER (PARTITION BY Year, GranPrix, LapNumber, Sector, SectorTime) - 1) / 2 AS Position
    FROM sec WHERE SectorTime IS NOT NULL
    WINDOW w AS (PARTITION BY Year, GranPrix, LapNumber, Sector ORDER BY SectorTime))"""


@query("set_union_all", f"{SECTOR_SQL} SELECT * FROM sec WHERE SectorTime IS NOT NULL")
def set_union_all(spark, sf):
    return N.sector_laps(role(spark, sf, "laps")).drop("SectorSessionTime")


@query("win_sector_rank", f"{SECTOR_SQL} SELECT * FROM ranked")
def win_sector_rank(spark, sf):
    return N.sector_rank(N.sector_laps(role(spark, sf, "laps"))).drop("SectorSessionTime")


@query(
    "join_sector_neighbours",
    f"""{SECTOR_SQL}, first AS (SELECT * FROM ranked QUALIFY row_number() OVER
        (PARTITION BY Year, GranPrix, LapNumber, Sector, Position ORDER BY DriverNumber) = 1)
    SELECT r.*, a.DriverNumber AS DriverAhead, a.SectorTime AS TimeAhead, b.DriverNumber AS DriverBehind,
        b.SectorTime AS TimeBehind, r.SectorTime - a.SectorTime AS DeltaToAhead, r.SectorTime - b.SectorTime AS DeltaToBehind
    FROM ranked r
    LEFT JOIN first a ON a.Year = r.Year AND a.GranPrix = r.GranPrix AND a.LapNumber = r.LapNumber
        AND a.Sector = r.Sector AND a.Position = r.Position - 1
    LEFT JOIN first b ON b.Year = r.Year AND b.GranPrix = r.GranPrix AND b.LapNumber = r.LapNumber
        AND b.Sector = r.Sector AND b.Position = r.Position + 1""",
)
def join_sector_neighbours(spark, sf):
    return N.sector_neighbours(N.sector_laps(role(spark, sf, "laps"))).drop("SectorSessionTime", "HalfSecondTimestamp")


@query(
    "set_intersect",
    """SELECT Year, GranPrix, LapNumber FROM laps WHERE Driver = 'D1' INTERSECT
    SELECT Year, GranPrix, LapNumber FROM laps WHERE Driver = 'D8'""",
)
def set_intersect(spark, sf):
    return N.common_laps(role(spark, sf, "laps"), "D1", "D8")
