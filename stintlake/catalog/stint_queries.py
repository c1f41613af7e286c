"""Stints, compounds and strategies."""

from pyspark.sql import functions as F

from stintlake.catalog.registry import R, query, r6
from stintlake.catalog.roles import COMPOUNDS, circuits, role, table
from stintlake.operators import circuits as CI
from stintlake.operators import laps as L
from stintlake.operators import stints as S

ID = ["Year", "GranPrix", "DriverNumber", "LapNumber"]
IDS = ", ".join(ID)
CAR = ID[:3]
CARS = ", ".join(CAR)

LENGTHS_SQL = f"""stint_laps AS (SELECT {CARS}, Stint, Compound, count(LapNumber) AS LapCount FROM laps
    WHERE Stint IS NOT NULL AND Compound IS NOT NULL GROUP BY ALL)"""


@query("agg_stint_length", f"{LENGTHS_SQL} SELECT * FROM stint_laps")
def agg_stint_length(spark, sf):
    return S.stint_length(role(spark, sf, "laps"))


@query(
    "win_stint_offset",
    f"""{LENGTHS_SQL} SELECT *, CAST(coalesce(sum(LapCount) OVER (PARTITION BY {CARS} ORDER BY Stint, Compound
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS StartLap FROM stint_laps""",
)
def win_stint_offset(spark, sf):
    return S.stint_offset(S.stint_length(role(spark, sf, "laps")))


@query(
    "win_stint_last",
    f"""SELECT {CARS}, Stint, max(LapNumber) AS LapNumber, arg_max(Driver, LapNumber) AS Driver,
        arg_max_null(Compound, LapNumber) AS Compound, arg_max(TyreLife, LapNumber) AS TyreLife
    FROM laps WHERE TyreLife > 0 GROUP BY ALL""",
)
def win_stint_last(spark, sf):
    return S.stint_last(role(spark, sf, "laps"))


@query(
    "win_stint_life_drop",
    f"""m AS (SELECT {IDS}, TyreLife, CASE WHEN TyreLife > 0 THEN Stint ELSE 0 END AS Stint,
        CASE WHEN TyreLife > 0 THEN Compound END AS Compound,
        CASE WHEN TyreLife > 0 THEN CAST(TyreLife AS BIGINT) * coalesce(length_m, 0) ELSE 0 END AS TireMeters
        FROM laps LEFT JOIN circuits USING (Location)),
    n AS (SELECT *, lead(TyreLife) OVER w AS nl, lead(TireMeters) OVER w AS nm, lead(1) OVER w AS more FROM m
        WINDOW w AS (PARTITION BY {CARS} ORDER BY LapNumber))
    SELECT {IDS}, Stint, Compound, coalesce(TyreLife, 0.0) AS TyreLife, TireMeters FROM n
    WHERE (nl > 0 AND nm <= TireMeters) OR (more IS NULL AND TyreLife > 0)""",
    ("laps", "circuits"),
)
def win_stint_life_drop(spark, sf):
    laps = CI.join_circuit(role(spark, sf, "laps"), circuits(spark, sf), similar=False)
    done = S.stint_life_drop(L.meters_zero_branch(laps))
    return done.select(*ID, "Stint", "Compound", "TyreLife", "TireMeters")


DIFF_SQL = f"""diffs AS (SELECT {IDS}, Stint, Compound, LapTime - lag(LapTime) OVER
        (PARTITION BY {CARS}, Stint, Compound ORDER BY LapNumber) AS LapTimeDelta
    FROM laps WHERE Stint IS NOT NULL AND Compound IS NOT NULL QUALIFY LapTimeDelta IS NOT NULL)"""


@query("win_laptime_diff", f"{DIFF_SQL} SELECT {IDS}, Stint, Compound, {R('LapTimeDelta')} AS LapTimeDelta FROM diffs")
def win_laptime_diff(spark, sf):
    done = S.laptime_diff(role(spark, sf, "laps"))
    return done.select(*ID, "Stint", "Compound", r6("LapTimeDelta").alias("LapTimeDelta"))


def _finite(expr: str) -> str:
    return R(f"CASE WHEN isfinite({expr}) THEN {expr} END")


@query(
    "agg_stint_trend",
    f"""{DIFF_SQL}, t AS (SELECT {CARS}, Stint, Compound, count(LapTimeDelta) AS n,
        regr_slope(LapTimeDelta, LapNumber) AS s, regr_intercept(LapTimeDelta, LapNumber) AS i FROM diffs GROUP BY ALL)
    SELECT {CARS}, Stint, Compound, n, {_finite("s")} AS slope, {_finite("i")} AS intercept FROM t""",
)
def agg_stint_trend(spark, sf):
    done = S.stint_trend(role(spark, sf, "laps"))
    return done.select(
        *CAR, "Stint", "Compound", "n", r6("slope").alias("slope"), r6("intercept").alias("intercept")
    )


@query(
    "agg_trend_fit",
    f"""t AS (SELECT {CARS}, regr_slope(LapTime, LapNumber) AS s, regr_intercept(LapTime, LapNumber) AS i
        FROM laps WHERE LapTime IS NOT NULL GROUP BY ALL)
    SELECT {IDS}, {_finite("s")} AS slope, {_finite("i")} AS intercept, {_finite("i + s * LapNumber")} AS fitted
    FROM laps JOIN t USING ({CARS}) WHERE LapTime IS NOT NULL""",
)
def agg_trend_fit(spark, sf):
    done = S.trend_fit(role(spark, sf, "laps"))
    return done.select(*ID, *[r6(c).alias(c) for c in ("slope", "intercept", "fitted")])


@query(
    "win_pit_detect",
    f"""SELECT {IDS}, NOT coalesce(Compound = prev, false) OR coalesce(LapTime > 1.5 * mean, false) AS is_pit
    FROM (SELECT *, lag(Compound) OVER (PARTITION BY {CARS} ORDER BY LapNumber) AS prev,
              avg(LapTime) OVER (PARTITION BY {CARS}) AS mean FROM laps)""",
)
def win_pit_detect(spark, sf):
    return S.pit_detect(role(spark, sf, "laps")).select(*ID, "is_pit")


STRATEGY_SQL = f"""firsts AS (SELECT {CARS}, coalesce(Compound, 'None') AS c, min(LapNumber) AS first_lap FROM laps GROUP BY ALL),
    used AS (SELECT {CARS}, string_agg(c, '_' ORDER BY first_lap, c) AS compound_strategy FROM firsts GROUP BY ALL)"""


@query(
    "win_compound_strategy",
    f"{STRATEGY_SQL} SELECT {IDS}, compound_strategy FROM laps JOIN used USING ({CARS})",
)
def win_compound_strategy(spark, sf):
    return S.compound_strategy(role(spark, sf, "laps")).select(*ID, "compound_strategy")


QUICK_SQL = """quick AS (SELECT * FROM (SELECT *, min(LapTime) OVER (PARTITION BY Year, GranPrix) AS best FROM laps)
    WHERE LapTime < 8 * best)"""


def _quick(spark, sf):
    return L.pick_quicklaps(role(spark, sf, "laps"), 8.0)


@query(
    "agg_compound_mean",
    f"""{QUICK_SQL} SELECT Compound, {R("avg(LapTime)")} AS avg_lap_time FROM quick
    WHERE Compound IS NOT NULL GROUP BY Compound""",
)
def agg_compound_mean(spark, sf):
    return S.compound_mean(_quick(spark, sf)).withColumn("avg_lap_time", r6("avg_lap_time"))


@query(
    "agg_compound_degradation",
    f"""SELECT Compound, {R("avg(LapTime)")} AS avg_lap_time,
        {R("(max(LapTime) - min(LapTime)) / count(*)")} AS degradation_rate
    FROM laps WHERE Compound IS NOT NULL GROUP BY Compound""",
)
def agg_compound_degradation(spark, sf):
    done = S.compound_degradation(role(spark, sf, "laps"))
    return done.select("Compound", r6("avg_lap_time").alias("avg_lap_time"), r6("degradation_rate").alias("degradation_rate"))


def strategies(spark, sf):
    """A two-stint strategy per part; some name a compound nobody drove."""
    n = F.col("p_partkey")
    names = F.array(*map(F.lit, [*COMPOUNDS, "ULTRASOFT"]))
    return table(spark, sf, "part").select(
        n.alias("strategy_id"),
        F.array(
            F.struct(F.get(names, (n % 6).cast("int")).alias("compound"), F.col("p_size").alias("laps")),
            F.struct(F.get(names, (n % 7).cast("int")).alias("compound"), (53 - F.col("p_size")).alias("laps")),
        ).alias("stints"),
    )


_NAMES = "['SOFT','MEDIUM','HARD','INTERMEDIATE','WET','HYPERSOFT','ULTRASOFT']"
COST_SQL = f"""means AS (SELECT Compound AS compound, avg(LapTime) AS avg_lap_time FROM laps
        WHERE Compound IS NOT NULL GROUP BY Compound),
    parts AS (SELECT p_partkey AS strategy_id, {_NAMES}[p_partkey % 6 + 1] AS compound, p_size AS n FROM part
        UNION ALL SELECT p_partkey, {_NAMES}[p_partkey % 7 + 1], 53 - p_size FROM part)"""


@query(
    "join_strategy_cost",
    f"""{COST_SQL} SELECT strategy_id, {R("sum(avg_lap_time * n)")} AS total_time FROM parts LEFT JOIN means USING (compound)
    GROUP BY strategy_id HAVING bool_and(avg_lap_time IS NOT NULL)""",
)
def join_strategy_cost(spark, sf):
    cost = S.strategy_cost(strategies(spark, sf), S.compound_mean(role(spark, sf, "laps")))
    return cost.withColumn("total_time", r6("total_time"))


@query(
    "join_strategy_cost_default",
    f"""{COST_SQL} SELECT strategy_id, {R('''sum(n * coalesce(avg_lap_time,
        CASE compound WHEN 'SOFT' THEN 90.0 WHEN 'MEDIUM' THEN 91.0 ELSE 92.0 END))''')} AS total_time
    FROM parts LEFT JOIN means USING (compound) GROUP BY strategy_id""",
)
def join_strategy_cost_default(spark, sf):
    cost = S.strategy_cost_default(strategies(spark, sf), S.compound_mean(role(spark, sf, "laps")))
    return cost.withColumn("total_time", r6("total_time"))


METERS_SQL = """m AS (SELECT *, CAST(TyreLife * length_m AS DOUBLE) AS TireMeters,
    CAST(LapNumber * length_m AS DOUBLE) AS DriverMeters FROM laps LEFT JOIN circuits USING (Location))"""


def _meters(spark, sf):
    return L.with_meters(CI.join_circuit(role(spark, sf, "laps"), circuits(spark, sf), similar=False))


@query(
    "agg_max_distance",
    f"""{METERS_SQL} SELECT Year, max(DriverMeters) AS max_race_distance, max(TireMeters) AS max_tyre_meters
    FROM m GROUP BY ROLLUP (Year)""",
    ("laps", "circuits"),
)
def agg_max_distance(spark, sf):
    return S.max_distance(_meters(spark, sf))


@query(
    "join_global_max",
    f"""{METERS_SQL} SELECT {IDS},
        {R("coalesce(TireMeters, 0) / (SELECT max(TireMeters) FROM m)")} AS NormalizedTireMeters,
        {R("coalesce(DriverMeters, 0) / (SELECT max(DriverMeters) FROM m)")} AS NormalizedDriverMeters FROM m""",
    ("laps", "circuits"),
)
def join_global_max(spark, sf):
    meters = _meters(spark, sf).fillna(0.0, ["TireMeters", "DriverMeters"])
    done = S.global_norm(meters, ["TireMeters", "DriverMeters"])
    return done.select(
        *ID,
        r6("NormalizedTireMeters").alias("NormalizedTireMeters"),
        r6("NormalizedDriverMeters").alias("NormalizedDriverMeters"),
    )


@query(
    "join_circuit",
    f"SELECT {IDS}, length_m FROM laps LEFT JOIN circuits USING (Location)",
    ("laps", "circuits"),
)
def join_circuit(spark, sf):
    return CI.join_circuit(role(spark, sf, "laps"), circuits(spark, sf), similar=False).select(*ID, "length_m")


@query(
    "join_circuit_similar",
    f"""near AS (SELECT DISTINCT l.Location, c.length_m FROM (SELECT DISTINCT Location FROM laps) l JOIN circuits c
        ON c.Location = l.Location OR contains(c.Location, l.Location) OR contains(l.Location, c.Location)
        QUALIFY row_number() OVER (PARTITION BY l.Location ORDER BY c.Location = l.Location DESC, file_order) = 1)
    SELECT {IDS}, length_m FROM laps LEFT JOIN near USING (Location)""",
    ("laps", "circuits"),
)
def join_circuit_similar(spark, sf):
    return CI.join_circuit(role(spark, sf, "laps"), circuits(spark, sf)).select(*ID, "length_m")


@query(
    "join_driver_codes",
    """SELECT l.event_id, r.Abbreviation FROM laps l LEFT JOIN results r USING (Year, GranPrix, DriverNumber)""",
    ("laps", "results"),
)
def join_driver_codes(spark, sf):
    codes = role(spark, sf, "results").select(*CAR, "Abbreviation")
    return role(spark, sf, "laps").join(codes, CAR, "left").select("event_id", "Abbreviation")


@query("agg_total_laps", "SELECT Year, GranPrix, max(LapNumber) AS total_laps FROM laps GROUP BY ALL")
def agg_total_laps(spark, sf):
    return S.total_laps(role(spark, sf, "laps"))


@query(
    "agg_fastest_lap",
    f"""SELECT {CARS}, LapTime, LapNumber, Driver, Compound FROM laps WHERE LapTime IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY {CARS} ORDER BY LapTime, LapNumber) = 1""",
)
def agg_fastest_lap(spark, sf):
    return S.fastest_lap(role(spark, sf, "laps"))


@query(
    "agg_fastest_lap_session",
    """SELECT Year, GranPrix, LapTime, LapNumber, Driver, DriverNumber FROM laps WHERE LapTime IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY Year, GranPrix ORDER BY LapTime, LapNumber, Driver) = 1""",
)
def agg_fastest_lap_session(spark, sf):
    return S.fastest_lap(role(spark, sf, "laps").drop("Compound"), ["Year", "GranPrix"])


@query(
    "agg_avg_finish",
    f"""SELECT Abbreviation AS driver, Year AS year,
        {R("avg(CASE WHEN DriverNumber % 5 <> 0 OR GranPrix <> 'Grand Prix 1' THEN Position END)")} AS avg_finish
    FROM results GROUP BY ALL""",
    ("results",),
)
def agg_avg_finish(spark, sf):
    no_finish = (F.col("DriverNumber") % 5 == 0) & (F.col("GranPrix") == "Grand Prix 1")
    season = role(spark, sf, "results").select(
        F.col("Abbreviation").alias("driver"),
        F.col("Year").alias("year"),
        F.when(no_finish, 0).otherwise(F.col("Position")).alias("position"),
    )
    return S.average_finish(season).withColumn("avg_finish", r6("avg_finish"))


@query(
    "agg_pit_duration",
    f"""SELECT {CARS}, {R("avg(Time - PitInTime)")} AS pit_duration FROM laps GROUP BY ALL""",
)
def agg_pit_duration(spark, sf):
    return S.pit_duration(role(spark, sf, "laps")).withColumn("pit_duration", r6("pit_duration"))


@query(
    "agg_pit_duration_paired",
    f"""SELECT {CARS}, {R("avg(nxt - PitInTime)")} AS pit_duration FROM (SELECT *,
        lead(PitOutTime) OVER (PARTITION BY {CARS} ORDER BY LapNumber) AS nxt FROM laps) GROUP BY ALL""",
)
def agg_pit_duration_paired(spark, sf):
    return S.pit_duration(role(spark, sf, "laps"), paired=True).withColumn("pit_duration", r6("pit_duration"))


@query(
    "win_position_series",
    f"""SELECT {CARS}, Driver, LapNumber, Position, CAST(row_number() OVER (PARTITION BY {CARS} ORDER BY LapNumber)
        AS INTEGER) AS n FROM laps WHERE Position IS NOT NULL""",
)
def win_position_series(spark, sf):
    return S.position_series(role(spark, sf, "laps"))


@query(
    "agg_laptime_distribution",
    f"""SELECT {CARS}, r.Position AS Finish, Compound, CAST(floor(LapTime) AS BIGINT) AS second, count(*) AS laps
    FROM (SELECT *, min(LapTime) OVER (PARTITION BY Year, GranPrix) AS best FROM laps) l
    JOIN (SELECT {CARS}, Position FROM results WHERE Position <= 10) r USING ({CARS})
    WHERE LapTime < 8 * best GROUP BY ALL""",
    ("laps", "results"),
)
def agg_laptime_distribution(spark, sf):
    return S.laptime_distribution(_quick(spark, sf), role(spark, sf, "results"))
