"""Projections and filters on laps."""

from pyspark.sql import functions as F

from stintlake.catalog.registry import R, query, r6
from stintlake.catalog.roles import circuits, role, table
from stintlake.functions import columns as C
from stintlake.operators import circuits as CI
from stintlake.operators import laps as L

ID = ["Year", "GranPrix", "DriverNumber", "LapNumber"]
IDS = ", ".join(ID)

RECORD_SQL = """SELECT Year, GranPrix, Location, DriverNumber AS DriverID, Driver, Team, LapNumber, Position,
    LapTime, Time, Stint, coalesce(Compound, 'UNKNOWN') AS Compound,
    coalesce(CAST(TyreLife AS INTEGER), 0) AS TyreLife, coalesce(FreshTyre, false) AS IsFreshTire,
    PitInTime IS NOT NULL AS PitInTime, PitOutTime IS NOT NULL AS PitOutTime FROM laps"""


@query("prj_lap_record", RECORD_SQL)
def prj_lap_record(spark, sf):
    return L.lap_record(role(spark, sf, "laps"))


# the first circuit, in file order, whose name holds the location or is held by it
LENGTH_SQL = """(SELECT coalesce(
        (SELECT length_m FROM circuits c WHERE c.Location = l.Location),
        (SELECT arg_min(length_m, file_order) FROM circuits c
         WHERE contains(c.Location, l.Location) OR contains(l.Location, c.Location))))"""


@query(
    "prj_meters",
    f"""SELECT {IDS}, TyreLife * length_m AS TireMeters, CAST(LapNumber * length_m AS DOUBLE) AS DriverMeters
    FROM (SELECT *, {LENGTH_SQL} AS length_m FROM laps l)""",
    ("laps", "circuits"),
)
def prj_meters(spark, sf):
    laps = CI.join_circuit(role(spark, sf, "laps"), circuits(spark, sf))
    return L.with_meters(laps).select(*ID, "TireMeters", "DriverMeters")


@query(
    "prj_meters_default",
    f"""SELECT {IDS}, TyreLife * length_m AS TireMeters, LapNumber * length_m AS DriverMeters
    FROM (SELECT *, CAST(coalesce({LENGTH_SQL}, 5000) AS DOUBLE) AS length_m FROM laps l)""",
    ("laps", "circuits"),
)
def prj_meters_default(spark, sf):
    laps = CI.join_circuit(role(spark, sf, "laps"), circuits(spark, sf), ignore_case=True)
    return L.with_meters(laps, unknown=5000).select(*ID, "TireMeters", "DriverMeters")


@query(
    "prj_meters_zero_branch",
    f"""SELECT {IDS}, CASE WHEN TyreLife > 0 THEN Stint ELSE 0 END AS Stint,
        CASE WHEN TyreLife > 0 THEN CAST(TyreLife AS BIGINT) * length_m ELSE 0 END AS TireMeters,
        CASE WHEN TyreLife > 0 THEN CAST(LapNumber AS BIGINT) * length_m ELSE 0 END AS DriverMeters,
        CASE WHEN TyreLife > 0 THEN Compound END AS Compound,
        CASE WHEN TyreLife > 0 THEN TyreLife ELSE 0.0 END AS TyreLife
    FROM (SELECT *, CAST(coalesce((SELECT length_m FROM circuits c WHERE c.Location = l.Location), 0) AS BIGINT)
              AS length_m FROM laps l)""",
    ("laps", "circuits"),
)
def prj_meters_zero_branch(spark, sf):
    laps = CI.join_circuit(role(spark, sf, "laps"), circuits(spark, sf), similar=False)
    return L.meters_zero_branch(laps).select(
        *ID, "Stint", "TireMeters", "DriverMeters", "Compound", "TyreLife"
    )


@query(
    "prj_flags01",
    f"""SELECT {IDS}, CAST(coalesce(FreshTyre, false) AS INTEGER) AS IsFreshTire,
        CAST(PitInTime IS NOT NULL AS INTEGER) AS PitIn, CAST(PitOutTime IS NOT NULL AS INTEGER) AS PitOut,
        CAST(IsPersonalBest AS INTEGER) AS Best FROM laps""",
)
def prj_flags01(spark, sf):
    return L.flags01(role(spark, sf, "laps")).select(*ID, "IsFreshTire", "PitIn", "PitOut", "Best")


@query(
    "prj_compound_code",
    f"""SELECT {IDS}, CASE Compound WHEN 'SOFT' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'HARD' THEN 3 ELSE 0 END
        AS CompoundCode FROM laps""",
)
def prj_compound_code(spark, sf):
    return L.with_compound_code(role(spark, sf, "laps")).select(*ID, "CompoundCode")


@query(
    "prj_encode_map",
    f"""SELECT {IDS}, coalesce(n_nationkey, -1) AS race_code
    FROM laps LEFT JOIN nation ON n_name = Location""",
)
def prj_encode_map(spark, sf):
    laps = role(spark, sf, "laps")
    codes = table(spark, sf, "nation")
    return L.encode_map(laps, "Location", codes, "n_name", "n_nationkey", "race_code").select(*ID, "race_code")


@query(
    "prj_ids",
    """SELECT Year || '_' || upper(replace(GranPrix, ' ', '_')) AS RaceID,
        Year || '_' || DriverNumber || '_' || upper(replace(GranPrix, ' ', '_')) AS DriverRaceID,
        Year || '_' || DriverNumber || '_' || upper(replace(GranPrix, ' ', '_')) || '_' || LapNumber AS GlobalLapID
    FROM laps""",
)
def prj_ids(spark, sf):
    return L.with_ids(role(spark, sf, "laps"), "DriverNumber").select("RaceID", "DriverRaceID", "GlobalLapID")


@query(
    "prj_sanitize",
    r"""SELECT doc_id, coalesce(nullif(regexp_replace(replace(text, ' ', '_'), '[^\p{L}\p{N}_-]', '', 'g'), ''),
        'unknown_event') AS token
    FROM documents""",
    (),
)
def prj_sanitize(spark, sf):
    return table(spark, sf, "documents").select("doc_id", C.sanitize_event("text").alias("token"))


@query(
    "prj_position_feats",
    f"""SELECT {IDS}, 21 - Position AS position_inverted,
        CAST(coalesce(Position <= 3, false) AS INTEGER) AS is_top_3,
        CAST(coalesce(Position <= 10, false) AS INTEGER) AS is_points_position FROM laps""",
)
def prj_position_feats(spark, sf):
    return L.position_features(role(spark, sf, "laps")).select(
        *ID, "position_inverted", "is_top_3", "is_points_position"
    )


@query(
    "prj_log_deltas",
    f"""SELECT event_id, {R("ln(1 + abs(LapTime))")} AS log_delta_ahead,
        {R("ln(1 + abs(Sector1Time - Sector2Time))")} AS log_delta_behind FROM laps""",
)
def prj_log_deltas(spark, sf):
    laps = role(spark, sf, "laps").select(
        "event_id",
        F.col("LapTime").alias("TimeDeltaToDriverAhead"),
        (F.col("Sector1Time") - F.col("Sector2Time")).alias("TimeDeltaToDriverBehind"),
    )
    return L.log_deltas(laps).select(
        "event_id", r6("log_delta_ahead").alias("log_delta_ahead"), r6("log_delta_behind").alias("log_delta_behind")
    )


@query(
    "prj_weather_flags",
    f"""SELECT event_id, CAST(coalesce(Rainfall, false) OR coalesce(Humidity > 80, false)
        OR coalesce(WindSpeed > 15, false) AS INTEGER) AS difficult_conditions,
        {R("TrackTemp - AirTemp")} AS temp_delta FROM weather""",
    ("weather",),
)
def prj_weather_flags(spark, sf):
    return L.weather_flags(role(spark, sf, "weather")).select(
        "event_id", "difficult_conditions", r6("temp_delta").alias("temp_delta")
    )


DOMAIN_SQL = """d AS (SELECT *, CASE Compound WHEN 'SOFT' THEN 15 WHEN 'MEDIUM' THEN 25 WHEN 'HARD' THEN 35
        WHEN 'SUPERSOFT' THEN 12 WHEN 'ULTRASOFT' THEN 10 WHEN 'INTERMEDIATE' THEN 20 WHEN 'WET' THEN 15
        ELSE 20 END AS expected_stint_length_domain FROM laps),
    ratios AS (SELECT *, TyreLife / expected_stint_length_domain AS stint_length_ratio FROM d)"""


@query(
    "prj_domain_stint",
    f"""{DOMAIN_SQL} SELECT {IDS}, expected_stint_length_domain,
        {R("stint_length_ratio")} AS stint_length_ratio FROM ratios""",
)
def prj_domain_stint(spark, sf):
    return L.domain_stint(role(spark, sf, "laps")).select(
        *ID, "expected_stint_length_domain", r6("stint_length_ratio").alias("stint_length_ratio")
    )


@query(
    "prj_pit_windows",
    f"""SELECT {IDS}, CAST(LapNumber BETWEEN 10 AND 20 AS INTEGER) AS in_pit_window_early,
        CAST(LapNumber BETWEEN 35 AND 45 AS INTEGER) AS in_pit_window_mid,
        CAST(LapNumber BETWEEN 55 AND 65 AS INTEGER) AS in_pit_window_late FROM laps""",
)
def prj_pit_windows(spark, sf):
    return L.pit_windows(role(spark, sf, "laps")).select(
        *ID, "in_pit_window_early", "in_pit_window_mid", "in_pit_window_late"
    )


@query(
    "prj_likely_stops",
    f"""{DOMAIN_SQL} SELECT {IDS}, coalesce(Stint = 1 AND stint_length_ratio > 0.15, false) AS likely_one_stop_15,
        coalesce(Stint = 1 AND stint_length_ratio > 1.5, false) AS likely_one_stop,
        coalesce(Stint >= 2 AND stint_length_ratio < 1.2, false) AS likely_two_stop FROM ratios""",
)
def prj_likely_stops(spark, sf):
    laps = L.likely_stops(L.domain_stint(role(spark, sf, "laps")))
    loose = F.coalesce((F.col("Stint") == 1) & (F.col("stint_length_ratio") > 0.15), F.lit(False))
    return laps.select(*ID, loose.alias("likely_one_stop_15"), "likely_one_stop", "likely_two_stop")


@query(
    "prj_lap_pct",
    f"""SELECT event_id, {R("fmod(Distance, 4321.0) / 4321.0 * 100")} AS pct FROM telemetry""",
    ("telemetry",),
)
def prj_lap_pct(spark, sf):
    return role(spark, sf, "telemetry").select(
        "event_id", r6(C.lap_percentage("Distance", F.lit(4321))).alias("pct")
    )


@query(
    "prj_floor_500ms",
    "SELECT event_id, floor(Time * 2) / 2 AS bucket FROM laps",
)
def prj_floor_500ms(spark, sf):
    return role(spark, sf, "laps").select("event_id", C.floor_half_second("Time").alias("bucket"))


@query(
    "prj_mmss",
    "SELECT event_id, printf('%02d:%02d', CAST(floor(Time) AS BIGINT) // 60, CAST(floor(Time) AS BIGINT) % 60) AS mmss FROM laps",
)
def prj_mmss(spark, sf):
    return role(spark, sf, "laps").select("event_id", C.minutes_seconds("Time").alias("mmss"))


@query(
    "fn_interval_seconds",
    f"""SELECT event_id, {R("CASE WHEN event_id % 5 = 0 THEN NULL ELSE floor(value * 1000) / 1000 END")} AS seconds
    FROM events""",
    (),
)
def fn_interval_seconds(spark, sf):
    """Parsing of seconds written as interval strings, as plain numbers and as junk."""
    ms = F.floor(F.col("value") * 1000).cast("long")
    text = F.format_string(
        "%d days %02d:%02d:%02d.%03d000",
        F.floor(ms / 86400000),
        F.pmod(F.floor(ms / 3600000), F.lit(24)),
        F.pmod(F.floor(ms / 60000), F.lit(60)),
        F.pmod(F.floor(ms / 1000), F.lit(60)),
        F.pmod(ms, F.lit(1000)),
    )
    shown = (
        F.when(F.col("event_id") % 5 == 0, F.lit("NaT"))
        .when(F.col("event_id") % 5 == 1, (ms / 1000).cast("string"))
        .otherwise(text)
    )
    return table(spark, sf, "events").select("event_id", r6(C.seconds_or_interval(shown)).alias("seconds"))


@query(
    "prj_select_strategy",
    "SELECT Year, GranPrix, Driver, Stint, Compound, LapNumber FROM laps",
)
def prj_select_strategy(spark, sf):
    return L.select_strategy(role(spark, sf, "laps"))


@query(
    "prj_lap_table",
    "SELECT Year, GranPrix, Driver, LapNumber, LapTime, Compound, Position FROM laps",
)
def prj_lap_table(spark, sf):
    return L.lap_table(role(spark, sf, "laps"))


@query(
    "prj_laptime_series",
    "SELECT Year, GranPrix, Driver, LapNumber, LapTime FROM laps ORDER BY 1, 2, 3, 4",
)
def prj_laptime_series(spark, sf):
    return L.laptime_series(role(spark, sf, "laps"))


def _register_filter(name, where, fn):
    @query(name, f"SELECT event_id, LapTime FROM laps WHERE {where}")
    def run(spark, sf):
        return fn(role(spark, sf, "laps")).select("event_id", "LapTime")


_register_filter("flt_driver", "Driver IN ('D1', 'D4', 'D7')", lambda d: L.pick_drivers(d, ["D1", "D4", "D7"]))
_register_filter("flt_tyre", "Compound = 'SOFT'", lambda d: L.pick_tyre(d, "SOFT"))
_register_filter("flt_lap", "LapNumber = 3", lambda d: L.pick_lap(d, 3))
_register_filter("flt_accurate", "IsAccurate", L.pick_accurate)
_register_filter(
    "flt_valid_laps",
    "IsAccurate AND LapTime IS NOT NULL AND PitInTime IS NULL AND PitOutTime IS NULL",
    L.valid_laps,
)


@query(
    "flt_quicklaps",
    """SELECT event_id, LapTime FROM (SELECT *, min(LapTime) OVER (PARTITION BY Year, GranPrix) AS best FROM laps)
    WHERE LapTime < 4.5 * best""",
)
def flt_quicklaps(spark, sf):
    return L.pick_quicklaps(role(spark, sf, "laps"), 4.5).select("event_id", "LapTime")


@query(
    "flt_quicklaps_team",
    """SELECT event_id, LapTime FROM (SELECT *, min(LapTime) OVER (PARTITION BY Year, GranPrix, Team) AS best FROM laps)
    WHERE LapTime < 2.5 * best""",
)
def flt_quicklaps_team(spark, sf):
    laps = role(spark, sf, "laps")
    return L.pick_quicklaps(laps, 2.5, by=["Year", "GranPrix", "Team"]).select("event_id", "LapTime")


@query(
    "flt_clean",
    """SELECT DISTINCT event_id, Year, DriverID, LapNumber, Position FROM (
        SELECT event_id, TRY_CAST(Year AS INTEGER) AS Year, TRY_CAST(DriverText AS BIGINT) AS DriverID, LapNumber, Position
        FROM (SELECT *, CASE WHEN event_id % 9 = 0 THEN 'n/a' ELSE CAST(DriverNumber AS VARCHAR) END AS DriverText FROM laps))
    WHERE Year IS NOT NULL AND DriverID IS NOT NULL AND LapNumber > 0 AND LapNumber <= 100
        AND Position > 0 AND Position <= 25""",
)
def flt_clean(spark, sf):
    laps = role(spark, sf, "laps").withColumn(
        "DriverID",
        F.when(F.col("event_id") % 9 == 0, F.lit("n/a")).otherwise(F.col("DriverNumber").cast("string")),
    )
    return L.clean(laps).select("event_id", "Year", "DriverID", "LapNumber", "Position").dropDuplicates()


@query(
    "flt_quantile_trim",
    """SELECT event_id, LapTime FROM laps WHERE LapTime BETWEEN
        (SELECT quantile_cont(LapTime, 0.01) FROM laps) AND (SELECT quantile_cont(LapTime, 0.99) FROM laps)""",
)
def flt_quantile_trim(spark, sf):
    return L.quantile_trim(role(spark, sf, "laps"), "LapTime").select("event_id", "LapTime")


@query(
    "flt_winner_others",
    """SELECT l.event_id, r.DriverNumber IS NOT NULL AS winner FROM laps l LEFT JOIN
        (SELECT * FROM results WHERE Position = 1) r USING (Year, GranPrix, DriverNumber)""",
    ("laps", "results"),
)
def flt_winner_others(spark, sf):
    first, others = L.winner_split(role(spark, sf, "laps"), role(spark, sf, "results"))
    return first.select("event_id", F.lit(True).alias("winner")).unionByName(
        others.select("event_id", F.lit(False).alias("winner"))
    )


@query(
    "flt_team",
    """SELECT event_id FROM laps SEMI JOIN (SELECT * FROM results WHERE TeamName = 'Team 3') r
    USING (Year, GranPrix, DriverNumber)""",
    ("laps", "results"),
)
def flt_team(spark, sf):
    return L.pick_team(role(spark, sf, "laps"), role(spark, sf, "results"), "Team 3").select("event_id")
