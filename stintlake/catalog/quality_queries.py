"""Profiles, validation, duplicates, quarantine."""

import uuid

from pyspark.sql import functions as F

from stintlake.catalog.registry import R, query, r6
from stintlake.catalog.roles import role, table
from stintlake.operators import laps as L
from stintlake.operators import quality as Q
from stintlake.operators import summaries as SU
from stintlake.session import staging_dir



def file_name():
    """``{year}_{round}`` of a lap, standing for the file it came from."""
    return F.concat(F.col("Year").cast("string"), F.lit("_"), F.lpad(F.col("RoundNumber").cast("string"), 2, "0"))


FILE_SQL = "Year || '_' || lpad(CAST(RoundNumber AS VARCHAR), 2, '0')"
PROFILED = (
    "Year GranPrix RoundNumber Location DriverNumber Driver Team LapNumber event_id Time LapStartTime LapTime PitInTime PitOutTime Stint "
    "TyreLife Compound FreshTyre IsPersonalBest IsAccurate Sector1Time Sector2Time Sector3Time Position"
).split()


def filed(spark, sf):
    """Laps as the files of their races."""
    laps = role(spark, sf, "laps")
    return laps.select(
        file_name().alias("file"), "Year", "GranPrix", F.col("DriverNumber").alias("DriverID"), "LapNumber", "Position", "LapTime"
    )


FILED = f"""f AS (SELECT {FILE_SQL} AS file, Year, GranPrix, DriverNumber AS DriverID, LapNumber, Position, LapTime FROM laps)"""


@query(
    "agg_year_stats",
    "SELECT Year, count(DISTINCT RaceID) AS races, count(DISTINCT DriverID) AS drivers, count(LapNumber) AS laps FROM dataset GROUP BY Year",
    ("dataset",),
)
def agg_year_stats(spark, sf):
    return Q.year_stats(role(spark, sf, "dataset"))


_MISSING = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, round((count(*) - count({c})) / count(*) * 100, 2) AS pct FROM laps"
    for c in PROFILED
)


@query("agg_missing_profile", f"SELECT * FROM ({_MISSING}) WHERE missing > 0")
def agg_missing_profile(spark, sf):
    return Q.missing_profile(role(spark, sf, "laps").select(*PROFILED))


@query("topk_missing", f"SELECT * FROM ({_MISSING}) WHERE missing > 0 ORDER BY missing DESC, \"column\" LIMIT 10")
def topk_missing(spark, sf):
    return Q.top_missing(role(spark, sf, "laps").select(*PROFILED), 10)


REPEATED = "SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 7 = 0"


def repeated(spark, sf):
    """Order lines, some of them twice in full."""
    rows = table(spark, sf, "lineitem")
    return rows.unionByName(rows.where("l_orderkey % 7 = 0"))


@query(
    "agg_duplicates",
    f"""SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates, CAST(sum(n) AS BIGINT) AS rows FROM
    (SELECT *, count(*) AS n FROM ({REPEATED}) GROUP BY ALL)""",
    (),
)
def agg_duplicates(spark, sf):
    return Q.duplicates(repeated(spark, sf))


RANGED = ["LapNumber", "Position", "LapTime", "TyreLife"]


@query(
    "agg_ranges",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM laps" for c in RANGED
    ),
)
def agg_ranges(spark, sf):
    return Q.ranges(role(spark, sf, "laps"), RANGED)


@query(
    "agg_value_counts_pct",
    f"SELECT Compound, count(*) AS n, {R('count(*) * 100 / (SELECT count(*) FROM laps)')} AS pct FROM laps WHERE Compound IS NOT NULL GROUP BY Compound",
)
def agg_value_counts_pct(spark, sf):
    return Q.value_counts_pct(role(spark, sf, "laps"), "Compound").withColumn("pct", r6("pct"))


@query(
    "agg_stint_stats",
    f"""SELECT Stint, count(TyreLife) AS n, {R("avg(TyreLife)")} AS mean, max(TyreLife) AS max FROM laps
    WHERE Stint IS NOT NULL GROUP BY ROLLUP (Stint)""",
)
def agg_stint_stats(spark, sf):
    return Q.stint_stats(role(spark, sf, "laps")).withColumn("mean", r6("mean"))


@query("agg_pit_count", "SELECT count(*) FILTER (PitInTime) AS pit_stops FROM dataset", ("dataset",))
def agg_pit_count(spark, sf):
    return Q.pit_count(role(spark, sf, "dataset"))


@query(
    "agg_target_balance",
    f"""SELECT changes, others, {R("changes * 100 / (changes + others)")} AS pct, {R("others / changes")} AS ratio FROM
    (SELECT CAST(sum(tire_change_next_lap) AS BIGINT) AS changes, CAST(count(*) - sum(tire_change_next_lap) AS BIGINT) AS others FROM targeted)""",
    ("targeted",),
)
def agg_target_balance(spark, sf):
    done = Q.target_balance(role(spark, sf, "targeted"))
    return done.withColumns({c: r6(c) for c in ("pct", "ratio")})


@query(
    "agg_type_balance",
    "SELECT next_tire_type, count(*) AS n FROM targeted WHERE tire_change_next_lap = 1 GROUP BY ALL",
    ("targeted",),
)
def agg_type_balance(spark, sf):
    return Q.type_balance(role(spark, sf, "targeted"))


COVERED = ["AirTemp", "TrackTemp", "Humidity", "WindSpeed", "LapTime", "Position", "TimeDeltaToDriverAhead"]


@query(
    "agg_coverage",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS known, {R(f'count({c}) * 100 / count(*)')} AS pct, {R(f'avg({c})')} AS mean FROM dataset"
        for c in COVERED
    ),
    ("dataset",),
)
def agg_coverage(spark, sf):
    done = Q.coverage(role(spark, sf, "dataset"), COVERED)
    return done.withColumns({c: r6(c) for c in ("pct", "mean")})


@query(
    "agg_histogram",
    """e AS (SELECT min(LapTime) AS lo, max(LapTime) AS hi FROM laps)
    SELECT CAST(least(floor((LapTime - lo) / (hi - lo) * 50), 49) AS INTEGER) AS bin, count(*) AS n
    FROM laps, e WHERE LapTime IS NOT NULL GROUP BY ALL""",
)
def agg_histogram(spark, sf):
    return Q.histogram(role(spark, sf, "laps"), "LapTime")


@query(
    "agg_histogram_trimmed",
    """q AS (SELECT LapTime FROM laps WHERE LapTime BETWEEN (SELECT quantile_cont(LapTime, 0.01) FROM laps)
        AND (SELECT quantile_cont(LapTime, 0.99) FROM laps)),
    e AS (SELECT min(LapTime) AS lo, max(LapTime) AS hi FROM q)
    SELECT CAST(least(floor((LapTime - lo) / (hi - lo) * 50), 49) AS INTEGER) AS bin, count(*) AS n FROM q, e GROUP BY ALL""",
)
def agg_histogram_trimmed(spark, sf):
    return Q.histogram(L.quantile_trim(role(spark, sf, "laps"), "LapTime"), "LapTime")


@query(
    "agg_validate",
    f"""{FILED}, rep AS (SELECT file, count(*) AS r FROM (SELECT file, Year, DriverID, LapNumber FROM f
        GROUP BY ALL HAVING count(*) > 1) GROUP BY file)
    SELECT file, count(*) AS n_rows, 6 AS n_columns, count(DISTINCT DriverID) AS n_drivers, count(DISTINCT LapNumber) AS n_laps,
        CAST(sum(CAST(Position IS NULL AS INTEGER) + CAST(LapTime IS NULL AS INTEGER)) AS BIGINT) AS missing_values,
        any_value(Year) AS year, any_value(GranPrix) AS event,
        coalesce(any_value(r) || ' repeated key groups', '') AS issues
    FROM f LEFT JOIN rep USING (file) GROUP BY file""",
)
def agg_validate(spark, sf):
    done = Q.validate(filed(spark, sf))
    return done.select(
        "file",
        "n_rows",
        "n_columns",
        "n_drivers",
        "n_laps",
        "missing_values",
        F.get("years", F.lit(0)).alias("year"),
        F.get("gran_prix", F.lit(0)).alias("event"),
        F.array_join("issues", "; ").alias("issues"),
    )


@query(
    "agg_quality_gate",
    f"""{FILED} SELECT file, count(*) AS n_rows,
        {R("avg(CAST(Position IS NULL AS INTEGER) + CAST(LapTime IS NULL AS INTEGER)) * 100 / 6")} AS missing_pct,
        avg(CAST(Position IS NULL AS INTEGER) + CAST(LapTime IS NULL AS INTEGER)) * 100 / 6 > 2.5 AS warn,
        count(*) >= 250 AS accepted FROM f GROUP BY file""",
)
def agg_quality_gate(spark, sf):
    gate = Q.quality_gate(filed(spark, sf), max_missing_pct=2.5, min_rows=250)
    return gate.withColumn("missing_pct", r6("missing_pct"))


@query(
    "flt_accepted_files",
    f"""{FILED} SELECT file, DriverID, LapNumber FROM f WHERE file IN (SELECT file FROM f GROUP BY file HAVING count(*) >= 250)""",
)
def flt_accepted_files(spark, sf):
    rows = filed(spark, sf)
    return Q.accepted_rows(rows, Q.quality_gate(rows, min_rows=250)).select("file", "DriverID", "LapNumber")


@query(
    "agg_consolidation",
    f"""{FILED} SELECT count(DISTINCT file) AS files_ok, count(*) AS rows, (SELECT string_agg(y, ',' ORDER BY y) FROM
        (SELECT DISTINCT CAST(Year AS VARCHAR) AS y FROM f)) AS years, count(DISTINCT DriverID) AS drivers,
        count(DISTINCT (Year, GranPrix)) AS races, (SELECT count(DISTINCT {FILE_SQL}) FROM laps WHERE RoundNumber = 5) AS files_failed
    FROM f""",
)
def agg_consolidation(spark, sf):
    failed = role(spark, sf, "laps").where("RoundNumber = 5").select(file_name().alias("file"))
    return Q.consolidation_stats(filed(spark, sf), failed=failed)


@query(
    "agg_consolidation_merged",
    f"""{FILED} SELECT count(DISTINCT file) AS files, count(*) AS rows,
        CAST(sum(CAST(Position IS NULL AS INTEGER) + CAST(LapTime IS NULL AS INTEGER)) AS BIGINT) AS missing_values,
        count(*) FILTER (LapNumber <= 1) AS first_laps, (SELECT string_agg(y, ',' ORDER BY y) FROM (SELECT DISTINCT CAST(Year AS VARCHAR) AS y FROM f)) AS years,
        (SELECT string_agg(e, ',' ORDER BY e) FROM (SELECT DISTINCT GranPrix AS e FROM f ORDER BY e LIMIT 10)) AS events,
        (SELECT count(DISTINCT GranPrix) > 10 FROM f) AS more_events, true AS drivers_near, true AS races_near FROM f""",
)
def agg_consolidation_merged(spark, sf):
    """Figures of all files, merged from the summaries that two runs stored; estimates within four standard errors."""
    path, files = f"{staging_dir(spark)}/summaries-{uuid.uuid4().hex}", filed(spark, sf)
    rules = {"first_laps": F.col("LapNumber") <= 1}
    for run, part in enumerate(("Year < 2021", "Year >= 2020")):  # the second run sums a season up again
        SU.store(SU.file_summaries(files.where(part), bad=rules, run=run, most=10), path)
    found = SU.merged(SU.stored(spark, path), most=10)
    exact = files.agg(F.struct(F.count_distinct("DriverID").alias("d"), F.count_distinct("Year", "GranPrix").alias("r")).alias("e")).scalar()

    def near(estimate, count):
        return F.abs(F.col(estimate) - count) <= F.greatest(F.lit(0.5), 4 * SU.relative_error() * count)

    text = F.array_join(F.transform("set_Year", lambda y: y.cast("string")), ",")
    return found.select(
        "files", "rows", "missing_values", F.col("bad_first_laps").alias("first_laps"), text.alias("years"),
        F.array_join("set_GranPrix", ",").alias("events"), F.col("more_GranPrix").alias("more_events"),
        near("DriverID", exact["d"]).alias("drivers_near"), near("Year_GranPrix", exact["r"]).alias("races_near"),
    )


DEDUPE = ["Year", "GranPrix", "Driver", "Compound"]


@query(
    "dedupe_subset",
    """SELECT event_id, Year, GranPrix, Driver, Compound FROM laps QUALIFY row_number() OVER
    (PARTITION BY Year, GranPrix, Driver, Compound ORDER BY event_id) = 1""",
)
def dedupe_subset(spark, sf):
    done = Q.dedupe_first(role(spark, sf, "laps"), [*DEDUPE, "TrackStatus"], ["event_id"])
    return done.select("event_id", *DEDUPE)


@query(
    "agg_unify_stats",
    """d AS (SELECT DISTINCT Year, GranPrix, Driver, Compound FROM laps)
    SELECT count(*) AS rows, 24 AS columns, min(Year) AS first_year, max(Year) AS last_year, count(DISTINCT Driver) AS drivers,
        count(DISTINCT (Year, GranPrix)) AS events, (SELECT count(*) FROM laps) - count(*) AS duplicates_removed FROM d""",
)
def agg_unify_stats(spark, sf):
    laps = role(spark, sf, "laps")
    return Q.unify_stats(laps, Q.dedupe_first(laps, DEDUPE, ["event_id"]))


@query(
    "dedupe_exact",
    f"SELECT DISTINCT * FROM ({REPEATED})",
    (),
)
def dedupe_exact(spark, sf):
    return Q.dedupe_exact(repeated(spark, sf))


def rules():
    return {
        "no lap start": ("race", F.col("LapStartTime").isNull()),
        "no lap time": ("lap", F.col("LapTime").isNull()),
        "no position": ("driver", F.col("Position").isNull()),
    }


_REASON = """CASE WHEN LapStartTime IS NULL THEN 'no lap start' WHEN LapTime IS NULL THEN 'no lap time'
    WHEN Position IS NULL THEN 'no position' END"""


@query("src_quarantine", f"SELECT event_id, {_REASON} AS reason FROM laps")
def src_quarantine(spark, sf):
    good, bad = Q.split_valid(role(spark, sf, "laps"), rules())
    return bad.select("event_id", "reason").unionByName(good.select("event_id", F.lit(None).cast("string").alias("reason")))


@query(
    "src_quarantine_summary",
    f"""b AS (SELECT *, {_REASON} AS reason FROM laps) SELECT CASE reason WHEN 'no lap start' THEN 'race'
        WHEN 'no lap time' THEN 'lap' ELSE 'driver' END AS level, reason, count(*) AS rows,
        count(DISTINCT (Year, GranPrix)) AS races FROM b WHERE reason IS NOT NULL GROUP BY ALL""",
)
def src_quarantine_summary(spark, sf):
    return Q.error_summary(Q.split_valid(role(spark, sf, "laps"), rules())[1])


@query("set_distinct", "SELECT DISTINCT Driver, Compound, Team FROM laps")
def set_distinct(spark, sf):
    return role(spark, sf, "laps").select("Driver", "Compound", "Team").distinct()


@query("agg_laps_total", "SELECT Driver, count(*) AS laps FROM laps GROUP BY ROLLUP (Driver)")
def agg_laps_total(spark, sf):
    return role(spark, sf, "laps").rollup("Driver").agg(F.count("*").alias("laps"))
