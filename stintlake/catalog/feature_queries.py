"""Race table, targets, features, fills and the learning data made of them."""

from pyspark.sql import functions as F

from stintlake.catalog.neighbour_queries import DELTAS_SQL, GAPS
from stintlake.catalog.registry import R, query, r6
from stintlake.catalog.roles import BUILDERS, ROLE_SQL, circuits, role
from stintlake.catalog.lap_queries import LENGTH_SQL
from stintlake.catalog.weather_queries import MEASURES, RANGE_SQL
from stintlake.operators import features as X
from stintlake.operators import laps as L
from stintlake.operators import mldata as M
from stintlake.plans import lap_analysis, lap_dataset, race_table

LAP = ["GlobalLapID"]


# -- roles built by the library's own plan ---------------------------------


def _build_race_laps(spark, sf):
    return race_table.race_table(
        role(spark, sf, "laps"), role(spark, sf, "weather"), circuits(spark, sf), weather_tie="event_id"
    )


def _build_dataset(spark, sf):
    return L.with_ids(role(spark, sf, "race_laps"))


def _build_targeted(spark, sf):
    return X.targets(X.by_car(role(spark, sf, "dataset"))).result()


BUILDERS["race_laps"] = _build_race_laps
BUILDERS["dataset"] = _build_dataset
BUILDERS["targeted"] = _build_targeted

_near = ", ".join(f"CASE WHEN i.n > 0 THEN i.{c} ELSE near.{c} END AS {c}" for c in [*MEASURES, "Rainfall"])
ROLE_SQL["race_laps"] = (
    ("laps", "weather", "circuits"),
    f"""WITH {RANGE_SQL}, placed AS (SELECT * FROM laps WHERE Position IS NOT NULL), {DELTAS_SQL},
    sized AS (SELECT *, {LENGTH_SQL} AS length_m FROM laps l)
    SELECT s.Year, s.GranPrix, s.Location, s.DriverNumber AS DriverID, s.Driver, s.Team, s.LapNumber, s.Position,
        s.LapTime, s.Time, s.Stint, coalesce(s.Compound, 'UNKNOWN') AS Compound,
        coalesce(CAST(s.TyreLife AS INTEGER), 0) AS TyreLife, coalesce(s.FreshTyre, false) AS IsFreshTire,
        s.PitInTime IS NOT NULL AS PitInTime, s.PitOutTime IS NOT NULL AS PitOutTime,
        coalesce(CAST(s.TyreLife AS INTEGER), 0) * CAST(length_m AS DOUBLE) AS TireMeters,
        s.LapNumber * CAST(length_m AS DOUBLE) AS DriverMeters, {_near}, {", ".join("d." + g for g in GAPS)}
    FROM sized s JOIN inside i USING (Year, GranPrix, DriverNumber, LapNumber)
    LEFT JOIN near USING (Year, GranPrix, DriverNumber, LapNumber)
    LEFT JOIN deltas d USING (Year, GranPrix, DriverNumber, LapNumber)""",
)
ROLE_SQL["dataset"] = (
    ("race_laps",),
    """SELECT *, Year || '_' || upper(replace(GranPrix, ' ', '_')) AS RaceID,
        Year || '_' || DriverID || '_' || upper(replace(GranPrix, ' ', '_')) AS DriverRaceID,
        Year || '_' || DriverID || '_' || upper(replace(GranPrix, ' ', '_')) || '_' || LapNumber AS GlobalLapID
    FROM race_laps""",
)
ROLE_SQL["targeted"] = (
    ("dataset",),
    """SELECT * EXCLUDE (ns, nc), CAST(ns IS NOT NULL AND ns IS DISTINCT FROM Stint AS INTEGER) AS tire_change_next_lap,
        CASE WHEN ns IS NOT NULL AND ns IS DISTINCT FROM Stint THEN nc ELSE 'NO_CHANGE' END AS next_tire_type
    FROM (SELECT *, lead(Stint) OVER w AS ns, lead(Compound) OVER w AS nc FROM dataset
        WINDOW w AS (PARTITION BY DriverRaceID ORDER BY LapNumber))""",
)

_ROUNDED = ["TireMeters", "DriverMeters", *MEASURES, *GAPS]


@query(
    "race_laps",
    f"SELECT * REPLACE ({', '.join(R(c) + f' AS {c}' for c in _ROUNDED)}) FROM race_laps",
    ("race_laps",),
)
def race_laps(spark, sf):
    """The whole race table from raw laps, weather and circuits."""
    done = _build_race_laps(spark, sf)
    return done.withColumns({c: r6(c) for c in _ROUNDED})


@query(
    "lap_analysis",
    f"""near AS (SELECT Year, GranPrix, LapNumber, Position, Driver, LapTime FROM laps WHERE Position IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY Year, GranPrix, LapNumber, Position ORDER BY DriverNumber) = 1),
    p AS (SELECT *, lag(Compound) OVER w AS prev, avg(LapTime) OVER (PARTITION BY Year, GranPrix, DriverNumber) AS mean
        FROM laps WINDOW w AS (PARTITION BY Year, GranPrix, DriverNumber ORDER BY LapNumber))
    SELECT p.Year, p.GranPrix, p.DriverNumber, p.Driver, p.LapNumber, p.Compound, p.LapTime, Sector1Time, Sector2Time,
        Sector3Time, p.Position, a.Driver AS DriverAhead, b.Driver AS DriverBehind,
        {R("abs(p.LapTime - a.LapTime)")} AS DiffToAhead, {R("abs(b.LapTime - p.LapTime)")} AS DiffToBehind,
        NOT coalesce(Compound = prev, false) OR coalesce(p.LapTime > 1.5 * mean, false) AS is_pit
    FROM p LEFT JOIN near a ON a.Year = p.Year AND a.GranPrix = p.GranPrix AND a.LapNumber = p.LapNumber
        AND a.Position = p.Position - 1
    LEFT JOIN near b ON b.Year = p.Year AND b.GranPrix = p.GranPrix AND b.LapNumber = p.LapNumber
        AND b.Position = p.Position + 1""",
)
def lap_analysis_all(spark, sf):
    done = lap_analysis.lap_analysis(role(spark, sf, "laps"))
    return done.withColumns({c: r6(c) for c in ("DiffToAhead", "DiffToBehind")})


# -- targets and features --------------------------------------------------


@query("win_tire_change", "SELECT GlobalLapID, tire_change_next_lap FROM targeted", ("targeted",))
def win_tire_change(spark, sf):
    return _build_targeted(spark, sf).select(*LAP, "tire_change_next_lap")


@query("win_next_tire_type", "SELECT GlobalLapID, next_tire_type FROM targeted", ("targeted",))
def win_next_tire_type(spark, sf):
    return _build_targeted(spark, sf).select(*LAP, "next_tire_type")


@query(
    "win_lap_progress",
    f"""SELECT GlobalLapID, {R('''CAST(LapNumber - min(LapNumber) OVER w AS DOUBLE)
        / nullif(max(LapNumber) OVER w - min(LapNumber) OVER w, 0)''')} AS lap_progress
    FROM dataset WINDOW w AS (PARTITION BY RaceID)""",
    ("dataset",),
)
def win_lap_progress(spark, sf):
    return X.lap_progress(role(spark, sf, "dataset")).select(*LAP, r6("lap_progress").alias("lap_progress"))


@query(
    "agg_compound_q75",
    f"""q AS (SELECT Compound, quantile_cont(CAST(TyreLife AS DOUBLE), 0.75) AS e FROM dataset GROUP BY Compound)
    SELECT GlobalLapID, {R("e")} AS expected_stint_length,
        {R("least(greatest(CASE WHEN e = 0 AND TyreLife > 0 THEN 2 ELSE TyreLife / nullif(e, 0) END, 0), 2)")} AS stint_progress
    FROM dataset LEFT JOIN q USING (Compound)""",
    ("dataset",),
)
def agg_compound_q75(spark, sf):
    done = X.stint_progress(role(spark, sf, "dataset"))
    return done.select(*LAP, *[r6(c).alias(c) for c in ("expected_stint_length", "stint_progress")])


@query(
    "agg_compound_q75_fit_years",
    f"""q AS (SELECT Compound, quantile_cont(CAST(TyreLife AS DOUBLE), 0.75) AS e FROM dataset
        WHERE Year IN (2018, 2019, 2020, 2021) GROUP BY Compound)
    SELECT GlobalLapID, {R("least(greatest(CASE WHEN e = 0 AND TyreLife > 0 THEN 2 ELSE TyreLife / nullif(e, 0) END, 0), 2)")} AS stint_progress
    FROM dataset LEFT JOIN q USING (Compound)""",
    ("dataset",),
)
def agg_compound_q75_fit_years(spark, sf):
    done = X.stint_progress(role(spark, sf, "dataset"), M.SPLIT_YEARS["train"])
    return done.select(*LAP, r6("stint_progress").alias("stint_progress"))


def _trend_sql(value: str, name: str) -> str:
    slope = f"regr_slope({value}, i) OVER last3"
    return f"""SELECT GlobalLapID, {R(f"CASE WHEN count({value}) OVER last3 >= 2 THEN {slope} END")} AS {name}
    FROM (SELECT *, CAST(row_number() OVER (PARTITION BY DriverRaceID ORDER BY LapNumber) AS DOUBLE) AS i FROM dataset)
    WINDOW last3 AS (PARTITION BY DriverRaceID ORDER BY LapNumber ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""


@query("win_laptime_trend3", _trend_sql("LapTime", "laptime_trend_3"), ("dataset",))
def win_laptime_trend3(spark, sf):
    done = X.rolling_trends(X.by_car(role(spark, sf, "dataset"))).result()
    return done.select(*LAP, r6("laptime_trend_3").alias("laptime_trend_3"))


@query("win_delta_ahead_trend", _trend_sql("TimeDeltaToDriverAhead", "delta_ahead_trend"), ("dataset",))
def win_delta_ahead_trend(spark, sf):
    done = X.rolling_trends(X.by_car(role(spark, sf, "dataset"))).result()
    return done.select(*LAP, r6("delta_ahead_trend").alias("delta_ahead_trend"))


@query(
    "win_degradation_rate",
    f"""SELECT GlobalLapID, {R("CASE WHEN Stint IS NULL THEN 0 ELSE coalesce(v / nullif(lag(v) OVER w, 0) - 1, 0) END")} AS tire_degradation_rate
    FROM (SELECT *, last_value(LapTime IGNORE NULLS) OVER (PARTITION BY DriverRaceID, Stint ORDER BY LapNumber) AS v FROM dataset)
    WINDOW w AS (PARTITION BY DriverRaceID, Stint ORDER BY LapNumber)""",
    ("dataset",),
)
def win_degradation_rate(spark, sf):
    done = X.degradation_rate(X.by_car(role(spark, sf, "dataset"))).result()
    return done.select(*LAP, r6("tire_degradation_rate").alias("tire_degradation_rate"))


@query(
    "win_compound_age_ratio",
    f"""q AS (SELECT RaceID, Compound, quantile_cont(CAST(TyreLife AS DOUBLE), 0.9) AS e FROM dataset GROUP BY ALL)
    SELECT GlobalLapID, {R("CASE WHEN e > 0 THEN TyreLife / e ELSE TyreLife END")} AS compound_age_ratio
    FROM dataset LEFT JOIN q USING (RaceID, Compound)""",
    ("dataset",),
)
def win_compound_age_ratio(spark, sf):
    done = X.compound_age_ratio(role(spark, sf, "dataset"))
    return done.select(*LAP, r6("compound_age_ratio").alias("compound_age_ratio"))


def _stability_sql(key: str) -> str:
    cols = ", ".join(
        R(f"CASE WHEN count({c}) OVER w >= 3 THEN stddev_samp({c}) OVER w ELSE 0 END") + f" AS {c}_stability"
        for c in X.INTERPOLATE
    )
    return f"""SELECT GlobalLapID, {cols} FROM dataset
    WINDOW w AS (PARTITION BY {key} ORDER BY DriverRaceID, LapNumber ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"""


def _stability(spark, sf, by):
    done = X.weather_stability(role(spark, sf, "dataset"), by)
    return done.select(*LAP, *[r6(f"{c}_stability").alias(f"{c}_stability") for c in X.INTERPOLATE])


@query("win_weather_stability", _stability_sql("RaceID"), ("dataset",))
def win_weather_stability(spark, sf):
    return _stability(spark, sf, "race")


@query("win_weather_stability_driver", _stability_sql("DriverRaceID"), ("dataset",))
def win_weather_stability_driver(spark, sf):
    return _stability(spark, sf, "driver")


@query(
    "ml_readme_feats",
    f"""cars AS (SELECT RaceID, LapNumber, count(DISTINCT DriverID) AS n FROM dataset GROUP BY ALL),
    total AS (SELECT RaceID, max(LapNumber) AS t FROM dataset GROUP BY ALL)
    SELECT GlobalLapID, {R("CAST(Position - 1 AS DOUBLE) / nullif(n - 1, 0)")} AS position_normalized,
        {R("CAST(LapNumber AS DOUBLE) / t")} AS race_progress,
        CAST(LapNumber % 20 BETWEEN 15 AND 20 AS INTEGER) AS in_pit_window
    FROM dataset JOIN cars USING (RaceID, LapNumber) JOIN total USING (RaceID)""",
    ("dataset",),
)
def ml_readme_feats(spark, sf):
    done = X.readme_features(role(spark, sf, "dataset"))
    return done.select(
        *LAP, *[r6(c).alias(c) for c in ("position_normalized", "race_progress")], "in_pit_window"
    )


# -- fills -----------------------------------------------------------------


@query(
    "win_ffill",
    """SELECT event_id, last_value(TyreLife IGNORE NULLS) OVER w AS TyreLife, last_value(Stint IGNORE NULLS) OVER w AS Stint,
        last_value(Compound IGNORE NULLS) OVER w AS Compound
    FROM laps WINDOW w AS (PARTITION BY Year, GranPrix, DriverNumber ORDER BY LapNumber)""",
)
def win_ffill(spark, sf):
    laps = L.with_ids(role(spark, sf, "laps"), "DriverNumber")
    return X.forward_fill(X.by_car(laps)).result().select("event_id", *X.FFILL)


def _interpolate_sql(limit: int | None) -> str:
    cut = f"AND i - pi <= {limit}" if limit else ""
    parts = []
    for c in X.INTERPOLATE:
        parts.append(
            f"""{c}_f AS (SELECT GlobalLapID, CASE WHEN {c} IS NOT NULL THEN {c} WHEN pv IS NULL THEN NULL
                WHEN true {cut} THEN CASE WHEN nv IS NULL THEN pv ELSE pv + (nv - pv) / (ni - pi) * (i - pi) END END AS {c}
            FROM (SELECT *, last_value({c} IGNORE NULLS) OVER b AS pv,
                    last_value(CASE WHEN {c} IS NOT NULL THEN i END IGNORE NULLS) OVER b AS pi,
                    first_value({c} IGNORE NULLS) OVER a AS nv,
                    first_value(CASE WHEN {c} IS NOT NULL THEN i END IGNORE NULLS) OVER a AS ni
                FROM n WINDOW b AS (PARTITION BY RaceID ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                    a AS (PARTITION BY RaceID ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)))"""
        )
    joins = " ".join(f"JOIN {c}_f USING (GlobalLapID)" for c in X.INTERPOLATE[1:])
    cols = ", ".join(R(c) + f" AS {c}" for c in X.INTERPOLATE)
    return f"""n AS (SELECT *, row_number() OVER (PARTITION BY RaceID ORDER BY DriverRaceID, LapNumber) AS i FROM dataset),
    {", ".join(parts)} SELECT GlobalLapID, {cols} FROM {X.INTERPOLATE[0]}_f {joins}"""


def _interpolate(spark, sf, limit):
    done = X.interpolate(X.by_race(role(spark, sf, "dataset")), limit=limit).result()
    return done.select(*LAP, *[r6(c).alias(c) for c in X.INTERPOLATE])


@query("win_interpolate", _interpolate_sql(None), ("dataset",))
def win_interpolate(spark, sf):
    return _interpolate(spark, sf, None)


@query("win_interpolate_limit", _interpolate_sql(3), ("dataset",))
def win_interpolate_limit(spark, sf):
    return _interpolate(spark, sf, 3)


@query(
    "ml_fill_median",
    "SELECT GlobalLapID, "
    + ", ".join(R(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM dataset))") + f" AS {c}" for c in X.MEDIAN)
    + " FROM dataset",
    ("dataset",),
)
def ml_fill_median(spark, sf):
    return X.fill_median(role(spark, sf, "dataset")).select(*LAP, *[r6(c).alias(c) for c in X.MEDIAN])


@query(
    "ml_fill_zero",
    "SELECT event_id, coalesce(LapTime, 0.0) AS LapTime, coalesce(Sector3Time, 0.0) AS Sector3Time FROM laps",
)
def ml_fill_zero(spark, sf):
    return X.fill_zero(role(spark, sf, "laps"), ["LapTime", "Sector3Time"]).select("event_id", "LapTime", "Sector3Time")


@query(
    "agg_mode_fill",
    """m AS (SELECT Year, GranPrix, Compound AS top FROM (SELECT Year, GranPrix, Compound, count(*) AS n FROM laps
        WHERE Compound IS NOT NULL GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY Year, GranPrix ORDER BY n DESC, Compound) = 1)
    SELECT event_id, coalesce(Compound, top, 'Unknown') AS Compound FROM laps LEFT JOIN m USING (Year, GranPrix)""",
)
def agg_mode_fill(spark, sf):
    return X.fill_mode(role(spark, sf, "laps"), ["Year", "GranPrix"], ["Compound"]).select("event_id", "Compound")


# -- splits, encodings, scaling --------------------------------------------

@query(
    "prj_fixed_norm",
    f"""SELECT GlobalLapID, {R("TireMeters / 30466")} AS NormalizedTireMeters, {R("DriverMeters / 470884")} AS NormalizedDriverMeters,
        {R("AirTemp / 61")} AS NormalizedAirTemp, {R("Humidity / 90")} AS NormalizedHumidity,
        {R("TrackTemp / 61")} AS NormalizedTrackTemp, {R("Pressure / 1013")} AS NormalizedPressure,
        {R("WindSpeed / 80")} AS NormalizedWindSpeed, {R("WindDirection / 360")} AS NormalizedWindDirection
    FROM dataset""",
    ("dataset",),
)
def prj_fixed_norm(spark, sf):
    done = L.fixed_norm(role(spark, sf, "dataset"))
    return done.select("GlobalLapID", *[r6(c).alias(c) for c in done.columns if c.startswith("Normalized")])


SPLIT_SQL = """split AS (SELECT *, CASE WHEN Year IN (2018, 2019, 2020, 2021) THEN 'train' WHEN Year = 2023 THEN 'val'
    ELSE 'test' END AS split FROM targeted WHERE Year IN (2018, 2019, 2020, 2021, 2023, 2024))"""


def _split(spark, sf):
    return M.split_years(role(spark, sf, "targeted"))


@query(
    "ml_split_years",
    f"""{SPLIT_SQL} SELECT split, count(*) AS rows, {R("avg(tire_change_next_lap) * 100")} AS positive_pct
    FROM split GROUP BY split""",
    ("targeted",),
)
def ml_split_years(spark, sf):
    return M.split_balance(_split(spark, sf)).withColumn("positive_pct", r6("positive_pct"))


ENCODED = lap_dataset.CATEGORIES


@query(
    "ml_label_encode",
    f"{SPLIT_SQL}, "
    + ", ".join(
        f"""c{i} AS (SELECT value AS v{i}, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS {c}_encoded
        FROM (SELECT DISTINCT coalesce({c}, 'nan') AS value FROM split WHERE split = 'train' UNION SELECT 'NO_CHANGE'))"""
        for i, c in enumerate(ENCODED)
    )
    + f" SELECT GlobalLapID, split, {', '.join(f'{c}_encoded' for c in ENCODED)} FROM split "
    + " ".join(f"LEFT JOIN c{i} ON v{i} = coalesce({c}, 'nan')" for i, c in enumerate(ENCODED)),
    ("targeted",),
)
def ml_label_encode(spark, sf):
    done = split = _split(spark, sf)
    for c in ENCODED:
        done = M.label_encode(done, c, M.label_codes(split.where("split = 'train'"), c))
    return done.select(*LAP, "split", *[f"{c}_encoded" for c in ENCODED])


@query(
    "ml_label_encode_other",
    f"""{SPLIT_SQL}, seen AS (SELECT Driver AS value, CAST(row_number() OVER (ORDER BY min(GlobalLapID)) - 1 AS INTEGER) AS code
        FROM split WHERE split = 'train' GROUP BY Driver),
    other AS (SELECT CAST(count(*) AS INTEGER) AS o FROM seen)
    SELECT GlobalLapID, coalesce(code, o) AS Driver_code, o + 1 AS width, coalesce(code, o) AS hot_at
    FROM split LEFT JOIN seen ON value = Driver, other""",
    ("targeted",),
)
def ml_label_encode_other(spark, sf):
    split = _split(spark, sf)
    codes = M.first_seen_codes(split.where("split = 'train'"), "Driver", ["GlobalLapID"])
    done = M.label_encode_other(split, "Driver", codes, "Driver_code")
    hot = F.col("Driver_code_onehot")
    return done.select(*LAP, "Driver_code", hot["size"].alias("width"), F.get(hot["indices"], F.lit(0)).alias("hot_at"))


@query(
    "ml_frequency_encode",
    """firsts AS (SELECT DriverRaceID, Compound, min(LapNumber) AS f FROM dataset GROUP BY ALL),
    used AS (SELECT DriverRaceID, string_agg(Compound, '_' ORDER BY f, Compound) AS compound_strategy FROM firsts GROUP BY ALL),
    merged AS (SELECT * FROM dataset JOIN used USING (DriverRaceID))
    SELECT GlobalLapID, compound_strategy, count(*) OVER (PARTITION BY compound_strategy) AS compound_strategy_freq FROM merged""",
    ("dataset",),
)
def ml_frequency_encode(spark, sf):
    rows = X.compound_strategy(role(spark, sf, "dataset"))
    return M.frequency_encode(rows).select(*LAP, "compound_strategy", "compound_strategy_freq")


SCALED = (
    "LapTime Time TyreLife TireMeters DriverMeters AirTemp Humidity TrackTemp Pressure WindSpeed WindDirection TimeDeltaToDriverAhead "
    "TimeDeltaToDriverTwoAhead TimeDeltaToDriverBehind TimeDeltaToDriverTwoBehind"
).split()


def _scale_expr(c: str) -> str:
    q = [f"(SELECT quantile_cont(CAST({c} AS DOUBLE), {p}) FROM split WHERE split = 'train')" for p in (0.25, 0.5, 0.75)]
    return R(f"({c} - {q[1]}) / CASE WHEN {q[2]} = {q[0]} THEN 1 ELSE {q[2]} - {q[0]} END") + f" AS {c}"


@query(
    "ml_robust_scale",
    f"{SPLIT_SQL} SELECT GlobalLapID, {', '.join(_scale_expr(c) for c in SCALED)} FROM split",
    ("targeted",),
)
def ml_robust_scale(spark, sf):
    split = _split(spark, sf)
    columns = M.scaled_columns(split)
    fit = M.robust_fit(split.where("split = 'train'"), columns)
    return M.robust_scale(split, columns, fit).select(*LAP, *[r6(c).alias(c) for c in SCALED])


# -- sequences -------------------------------------------------------------

SEQ = ["LapTime", "TyreLife", "TrackTemp", "Position"]
SEQ_ALL = [*SCALED, "Position", "Stint"]
_CODES = "CASE next_tire_type WHEN 'SOFT' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'HARD' THEN 3 ELSE 0 END"


def sequences(spark, sf, features=SEQ):
    """Ten-lap sequences with null features as they are."""
    rows = role(spark, sf, "targeted")
    code = F.when(F.col("next_tire_type") == "SOFT", 1).when(F.col("next_tire_type") == "MEDIUM", 2)
    code = code.when(F.col("next_tire_type") == "HARD", 3).otherwise(0)
    return M.sequences(rows.withColumn("_type", code), features, 10, "_type")


def sequence_sql(features=SEQ):
    return f"""n AS (SELECT *, row_number() OVER (PARTITION BY DriverRaceID ORDER BY LapNumber) AS i,
        {_CODES} AS y_type FROM targeted),
    seq AS (SELECT e.DriverRaceID, e.LapNumber, CAST(s.i - e.i + 9 AS INTEGER) AS step,
        {", ".join(f"CAST(s.{c} AS FLOAT) AS {c}" for c in features)}, e.tire_change_next_lap AS y_change, e.y_type
    FROM n e JOIN n s ON s.DriverRaceID = e.DriverRaceID AND s.i BETWEEN e.i - 9 AND e.i WHERE e.i >= 10)"""


SEQ_SQL = sequence_sql()


@query(
    "win_sequences",
    f"""{sequence_sql(SEQ_ALL)} SELECT DriverRaceID, LapNumber, step, {", ".join(R(c) + f" AS {c}" for c in SEQ_ALL)}, y_change, y_type FROM seq""",
    ("targeted",),
)
def win_sequences(spark, sf):
    rows = sequences(spark, sf, SEQ_ALL).select("*", F.posexplode("X").alias("step", "row"))
    cols = [r6(F.get("row", F.lit(i))).alias(c) for i, c in enumerate(SEQ_ALL)]
    return rows.select("DriverRaceID", "LapNumber", "step", *cols, "y_change", "y_type")


@query(
    "ml_pad_laps",
    """known AS (SELECT Year, GranPrix, DriverNumber, LapNumber, coalesce(LapTime, -1) AS LapTime,
            coalesce(Sector3Time, -1) AS Sector3Time FROM laps),
    cars AS (SELECT Year, GranPrix, DriverNumber, count(*) AS n FROM laps GROUP BY ALL)
    SELECT * FROM known UNION ALL
    SELECT Year, GranPrix, DriverNumber, CAST(i AS INTEGER), -1.0, -1.0
    FROM (SELECT *, unnest(range(n + 1, 79)) AS i FROM cars)""",
)
def ml_pad_laps(spark, sf):
    return M.pad_laps(role(spark, sf, "laps"), ["Year", "GranPrix", "DriverNumber"], ["LapTime", "Sector3Time"])


@query(
    "agg_tensor_profile",
    f"""{SEQ_SQL}, v AS (SELECT CASE WHEN LapNumber % 11 = 0 AND k = 1 THEN 'nan'::FLOAT
            WHEN LapNumber % 11 = 5 AND k = 2 THEN 'inf'::FLOAT ELSE [LapTime, TyreLife, TrackTemp, Position][k] END AS x
        FROM seq, (SELECT unnest([1, 2, 3, 4]) AS k))
    SELECT count(*) FILTER (isnan(x)) AS n_nan, count(*) FILTER (isinf(x)) AS n_inf,
        CAST(min(x) FILTER (NOT isnan(x) AND NOT isinf(x)) AS DOUBLE) AS min,
        {R("avg(CAST(x AS DOUBLE)) FILTER (NOT isnan(x) AND NOT isinf(x))")} AS finite_mean,
        {R("stddev_pop(CAST(x AS DOUBLE)) FILTER (NOT isnan(x) AND NOT isinf(x))")} AS finite_std FROM v""",
    ("targeted",),
)
def agg_tensor_profile(spark, sf):
    whole = M.tensor_profile(broken_sequences(spark, sf))
    finite = M.tensor_profile(broken_sequences(spark, sf, drop=True))
    other = finite.select(F.struct("mean", "std").alias("f")).scalar()
    return whole.select(
        "n_nan", "n_inf", "min", r6(other["mean"]).alias("finite_mean"), r6(other["std"]).alias("finite_std")
    )


@query(
    "agg_tensor_profile_whole",
    f"""{SEQ_SQL}, v AS (SELECT CAST([LapTime, TyreLife, TrackTemp, Position][k] AS DOUBLE) AS x FROM seq, (SELECT unnest([1, 2, 3, 4]) AS k))
    SELECT count(*) FILTER (isnan(x)) AS n_nan, count(*) FILTER (isinf(x)) AS n_inf, min(x) AS min, max(x) AS max,
        {R("avg(x)")} AS mean, {R("stddev_pop(x)")} AS std FROM v""",
    ("targeted",),
)
def agg_tensor_profile_whole(spark, sf):
    """All figures of the tensor of all sequences: what is not a number, the ends, mean and deviation."""
    return M.tensor_profile(sequences(spark, sf)).withColumns({c: r6(c) for c in ("mean", "std")})


def broken_sequences(spark, sf, drop=False):
    """Sequences with not-a-number and infinite values put in by lap, or nulls there with ``drop``."""
    lap = F.col("LapNumber") % 11
    nan, inf = (F.lit(None).cast("float"),) * 2 if drop else (F.lit(float("nan")).cast("float"), F.lit(float("inf")).cast("float"))

    def broken(x, i):
        return F.when((lap == 0) & (i == 0), nan).when((lap == 5) & (i == 1), inf).otherwise(x)

    return sequences(spark, sf).withColumn("X", F.transform("X", lambda r: F.transform(r, broken)))


@query(
    "ml_clean_tensor",
    f"""{SEQ_SQL}, v AS (SELECT DriverRaceID, LapNumber, step, k, CASE WHEN LapNumber % 11 = 0 AND k = 1 THEN 0
            WHEN LapNumber % 11 = 5 AND k = 2 THEN 3.4028234663852886e37
            ELSE coalesce(CAST([LapTime, TyreLife, TrackTemp, Position][k] AS DOUBLE), 0) END AS x
        FROM seq, (SELECT unnest([1, 2, 3, 4]) AS k)),
    b AS (SELECT quantile_cont(x, 0.01) * 10 AS lo, quantile_cont(x, 0.99) * 10 AS hi FROM v)
    SELECT DriverRaceID, LapNumber, step, CAST(k - 1 AS INTEGER) AS feature, {R("least(greatest(x, lo), hi)")} AS x FROM v, b""",
    ("targeted",),
)
def ml_clean_tensor(spark, sf):
    cleaned = M.clean_tensor(broken_sequences(spark, sf))
    rows = cleaned.select("DriverRaceID", "LapNumber", F.posexplode("X").alias("step", "r"))
    return rows.select("DriverRaceID", "LapNumber", "step", F.posexplode("r").alias("feature", "x")).withColumn("x", r6("x"))


# -- class balance and model -----------------------------------------------


def _weights_sql(factor: int) -> str:
    return f"""c AS (SELECT class, n * CASE WHEN class = 1 THEN {factor} ELSE 1 END AS n
        FROM (SELECT tire_change_next_lap AS class, count(*) AS n FROM targeted GROUP BY ALL))
    SELECT class, n, {R("(SELECT sum(n) FROM c) / (2.0 * n)")} AS weight FROM c"""


@query("agg_class_weights", _weights_sql(1), ("targeted",))
def agg_class_weights(spark, sf):
    done = M.class_weights(role(spark, sf, "targeted"), "tire_change_next_lap")
    return done.withColumn("weight", r6("weight"))


@query("agg_class_weights_augmented", _weights_sql(3), ("targeted",))
def agg_class_weights_augmented(spark, sf):
    done = M.class_weights(role(spark, sf, "targeted"), "tire_change_next_lap", factor=3)
    return done.withColumn("weight", r6("weight"))


def _uniform_sql(*parts: str) -> str:
    text = " || '|' || ".join(["'7'", *parts])
    return f"((('0x' || substr(md5({text}), 1, 8))::BIGINT + 0.5) / 4294967296.0)"


def _noisy_sql(c: str, place: int) -> str:
    at = ["DriverRaceID", "LapNumber", "copy", "step", f"'{place}'"]
    size, turn = _uniform_sql("'size'", *at), _uniform_sql("'turn'", *at)
    value = f"CAST({c} + 0.01 * sqrt(-2 * ln({size})) * cos(2 * pi() * {turn}) AS FLOAT)"
    return f"{R(f'CASE WHEN copy = 0 THEN {c} ELSE {value} END')} AS {c}"


@query(
    "ml_augment",
    f"""{SEQ_SQL} SELECT DriverRaceID, LapNumber, step, copy, {", ".join(_noisy_sql(c, j) for j, c in enumerate(SEQ))}, y_change
    FROM seq, (SELECT CAST(unnest(range(3)) AS INTEGER) AS copy) WHERE copy = 0 OR y_change = 1""",
    ("targeted",),
)
def ml_augment(spark, sf):
    done = M.augment(sequences(spark, sf), ["DriverRaceID", "LapNumber"]).select("*", F.posexplode("X").alias("step", "row"))
    cols = [r6(F.get("row", F.lit(i))).alias(c) for i, c in enumerate(SEQ)]
    return done.select("DriverRaceID", "LapNumber", "step", "copy", *cols, "y_change")


@query(
    "ml_weighted_sample",
    f"""c AS (SELECT tire_change_next_lap AS class, count(*) AS n FROM targeted GROUP BY ALL),
    w AS (SELECT class, n, sum(n) OVER () / (n * 2.0) AS weight FROM c),
    r AS (SELECT class, sum(n) OVER () * weight / sum(n * weight) OVER () AS rate FROM w),
    f AS (SELECT class, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY class ORDER BY k) AS cdf
        FROM r, (SELECT unnest(range(400)) AS k) WHERE k < ceil(rate + 12 * sqrt(rate + 1) + 12)),
    u AS (SELECT GlobalLapID, tire_change_next_lap AS class, {_uniform_sql("'size'", "GlobalLapID")} AS u FROM targeted),
    t AS (SELECT GlobalLapID, class, (SELECT count(*) FROM f WHERE f.class = u.class AND cdf < u.u) AS times FROM u)
    SELECT GlobalLapID, class AS tire_change_next_lap, CAST(unnest(range(1, times + 1)) AS INTEGER) AS draw FROM t""",
    ("targeted",),
)
def ml_weighted_sample(spark, sf):
    rows = role(spark, sf, "targeted")
    weights = M.class_weights(rows, "tire_change_next_lap")
    drawn = M.weighted_sample(rows, ["GlobalLapID"], weights, rows.count(), "tire_change_next_lap")
    return drawn.select("GlobalLapID", "tire_change_next_lap", "draw")


@query("feature_table")
def feature_table(spark, sf):
    """All engineered columns of the lap dataset, through the whole plan."""
    return lap_dataset.features(lap_dataset.dataset(role(spark, sf, "race_laps")))


# -- the whole table, step by step in SQL ------------------------------------

_SLOPE = "CASE WHEN count({0}) OVER last3 >= 2 THEN regr_slope({0}, i) OVER last3 END"


def _filled_sql() -> str:
    """Interpolation of the weather columns by row of the race, as in ``_interpolate_sql``, all at once."""
    known, filled = [], []
    for c in X.INTERPOLATE:
        known.append(
            f"""last_value({c} IGNORE NULLS) OVER b AS pv_{c}, last_value(CASE WHEN {c} IS NOT NULL THEN j END IGNORE NULLS) OVER b AS pi_{c},
            first_value({c} IGNORE NULLS) OVER a AS nv_{c}, first_value(CASE WHEN {c} IS NOT NULL THEN j END IGNORE NULLS) OVER a AS ni_{c}"""
        )
        between = f"pv_{c} + (nv_{c} - pv_{c}) / (ni_{c} - pi_{c}) * (j - pi_{c})"
        filled.append(f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN pv_{c} IS NULL THEN NULL WHEN nv_{c} IS NULL THEN pv_{c} ELSE {between} END AS {c}")
    return f"""SELECT * REPLACE ({", ".join(filled)}) FROM (SELECT *, {", ".join(known)}
        FROM (SELECT *, row_number() OVER (PARTITION BY RaceID ORDER BY DriverRaceID, LapNumber) AS j FROM ff)
        WINDOW b AS (PARTITION BY RaceID ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
            a AS (PARTITION BY RaceID ORDER BY j ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


_STABLE = ", ".join(f"CASE WHEN count({c}) OVER last5 >= 3 THEN stddev_samp({c}) OVER last5 ELSE 0 END AS {c}_stability" for c in X.INTERPOLATE)
_ENGINEERED = [
    "laptime_trend_3", "delta_ahead_trend", "tire_degradation_rate", "log_delta_ahead", "log_delta_behind", "temp_delta", "stint_length_ratio",
    "lap_progress", "expected_stint_length", "stint_progress", "compound_age_ratio", *[f"{c}_stability" for c in X.INTERPOLATE],
]
_MEASURED = ["LapTime", "Time", "TireMeters", "DriverMeters", *MEASURES, *GAPS]
_HELPERS = "ns, nc, i, v, q75, q90, used, j, " + ", ".join(f"{k}_{c}" for c in X.INTERPOLATE for k in ("pv", "pi", "nv", "ni"))

FEATURE_SQL = f"""c AS (SELECT DISTINCT * FROM race_laps WHERE LapNumber BETWEEN 1 AND 100 AND Position BETWEEN 1 AND 25 AND DriverID IS NOT NULL),
    ids AS (SELECT *, Year || '_' || upper(replace(GranPrix, ' ', '_')) AS RaceID,
        Year || '_' || DriverID || '_' || upper(replace(GranPrix, ' ', '_')) AS DriverRaceID,
        Year || '_' || DriverID || '_' || upper(replace(GranPrix, ' ', '_')) || '_' || LapNumber AS GlobalLapID FROM c),
    tg AS (SELECT *, CAST(ns IS NOT NULL AND ns IS DISTINCT FROM Stint AS INTEGER) AS tire_change_next_lap,
        CASE WHEN ns IS NOT NULL AND ns IS DISTINCT FROM Stint THEN nc ELSE 'NO_CHANGE' END AS next_tire_type
        FROM (SELECT *, lead(Stint) OVER w AS ns, lead(Compound) OVER w AS nc, CAST(row_number() OVER w AS DOUBLE) AS i FROM ids
            WINDOW w AS (PARTITION BY DriverRaceID ORDER BY LapNumber))),
    tr AS (SELECT *, {_SLOPE.format("LapTime")} AS laptime_trend_3, {_SLOPE.format("TimeDeltaToDriverAhead")} AS delta_ahead_trend,
        last_value(LapTime IGNORE NULLS) OVER (PARTITION BY DriverRaceID, Stint ORDER BY LapNumber) AS v FROM tg
        WINDOW last3 AS (PARTITION BY DriverRaceID ORDER BY LapNumber ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
    dg AS (SELECT *, CASE WHEN Stint IS NULL THEN 0 ELSE coalesce(v / nullif(lag(v) OVER (PARTITION BY DriverRaceID, Stint ORDER BY LapNumber), 0) - 1, 0) END
            AS tire_degradation_rate,
        21 - Position AS position_inverted, CAST(Position <= 3 AS INTEGER) AS is_top_3, CAST(Position <= 10 AS INTEGER) AS is_points_position,
        ln(1 + abs(TimeDeltaToDriverAhead)) AS log_delta_ahead, ln(1 + abs(TimeDeltaToDriverBehind)) AS log_delta_behind,
        CAST(coalesce(Rainfall, false) OR coalesce(Humidity > 80, false) OR coalesce(WindSpeed > 15, false) AS INTEGER) AS difficult_conditions,
        TrackTemp - AirTemp AS temp_delta, CAST(LapNumber BETWEEN 10 AND 20 AS INTEGER) AS in_pit_window_early,
        CAST(LapNumber BETWEEN 35 AND 45 AS INTEGER) AS in_pit_window_mid, CAST(LapNumber BETWEEN 55 AND 65 AS INTEGER) AS in_pit_window_late,
        CASE Compound WHEN 'SOFT' THEN 15 WHEN 'MEDIUM' THEN 25 WHEN 'HARD' THEN 35 WHEN 'SUPERSOFT' THEN 12 WHEN 'ULTRASOFT' THEN 10
            WHEN 'INTERMEDIATE' THEN 20 WHEN 'WET' THEN 15 ELSE 20 END AS expected_stint_length_domain FROM tr),
    dm AS (SELECT *, TyreLife / expected_stint_length_domain AS stint_length_ratio,
        coalesce(Stint = 1 AND TyreLife / expected_stint_length_domain > 1.5, false) AS likely_one_stop,
        coalesce(Stint >= 2 AND TyreLife / expected_stint_length_domain < 1.2, false) AS likely_two_stop,
        CAST(LapNumber - min(LapNumber) OVER r AS DOUBLE) / nullif(max(LapNumber) OVER r - min(LapNumber) OVER r, 0) AS lap_progress
        FROM dg WINDOW r AS (PARTITION BY RaceID)),
    by_kind AS (SELECT Compound, quantile_cont(CAST(TyreLife AS DOUBLE), 0.75) AS q75 FROM dm GROUP BY Compound),
    by_race AS (SELECT RaceID, Compound, quantile_cont(CAST(TyreLife AS DOUBLE), 0.9) AS q90 FROM dm GROUP BY ALL),
    firsts AS (SELECT DriverRaceID, Compound, min(LapNumber) AS f FROM dm GROUP BY ALL),
    strategies AS (SELECT DriverRaceID, string_agg(Compound, '_' ORDER BY f, Compound) AS used FROM firsts GROUP BY ALL),
    st AS (SELECT *, q75 AS expected_stint_length,
        least(greatest(CASE WHEN q75 = 0 AND TyreLife > 0 THEN 2 ELSE TyreLife / nullif(q75, 0) END, 0), 2) AS stint_progress,
        CASE WHEN q90 > 0 THEN TyreLife / q90 ELSE TyreLife END AS compound_age_ratio, used AS compound_strategy, {_STABLE}
        FROM dm LEFT JOIN by_kind USING (Compound) LEFT JOIN by_race USING (RaceID, Compound) JOIN strategies USING (DriverRaceID)
        WINDOW last5 AS (PARTITION BY RaceID ORDER BY DriverRaceID, LapNumber ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)),
    ff AS (SELECT * REPLACE (last_value(TyreLife IGNORE NULLS) OVER w AS TyreLife, last_value(Stint IGNORE NULLS) OVER w AS Stint,
        last_value(Compound IGNORE NULLS) OVER w AS Compound) FROM st WINDOW w AS (PARTITION BY DriverRaceID ORDER BY LapNumber)),
    ip AS ({_filled_sql()}),
    done AS (SELECT * EXCLUDE ({_HELPERS}) REPLACE (
        {", ".join(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM ip)) AS {c}" for c in X.MEDIAN)}, {", ".join(f"coalesce({c}, 0.0) AS {c}" for c in X.ZERO)}) FROM ip)
    SELECT * REPLACE ({", ".join(R(c) + f" AS {c}" for c in [*_MEASURED, *_ENGINEERED])}) FROM done"""


@query("feature_table_rounded", FEATURE_SQL, ("race_laps",))
def feature_table_rounded(spark, sf):
    """All engineered columns of the cleaned laps without repeats, to six decimals, next to every step in SQL."""
    done = lap_dataset.features(lap_dataset.dataset(role(spark, sf, "race_laps")))
    return done.withColumns({c: r6(c) for c in [*_MEASURED, *_ENGINEERED]})
