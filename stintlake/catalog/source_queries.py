"""Sources, sinks, calendars, ingestion and the baseline model: written, read back, compared."""

import uuid
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.catalog.feature_queries import SEQ_ALL, SPLIT_SQL
from stintlake.catalog.quality_queries import FILE_SQL, file_name
from stintlake.catalog.registry import R as r6_sql
from stintlake.catalog.registry import query, r6
from stintlake.catalog.roles import role, table
from stintlake.functions.joins import join_small
from stintlake.operators import features as X
from stintlake.operators import metrics as ME
from stintlake.operators import mldata as M
from stintlake.operators import neighbours as N
from stintlake.operators import stints as S
from stintlake.plans import lap_dataset, learning_store, tyre_model, unify
from stintlake.session import stage, staging_dir
from stintlake.sources import calendar as C
from stintlake.sources import incremental as I
from stintlake.sources import readers as R
from stintlake.sources import sinks as W
from stintlake.streaming import ingest


def _new(spark, name):
    return f"{staging_dir(spark)}/{name}-{uuid.uuid4().hex}"


LAP_COLUMNS = ["Year", "RoundNumber", "GranPrix", "DriverNumber", "LapNumber", "LapTime", "Compound"]
LAP_LIST = ", ".join(LAP_COLUMNS)


def _laps(spark, sf):
    return role(spark, sf, "laps").select(*LAP_COLUMNS)


# -- scans -----------------------------------------------------------------


@query("src_parquet", "SELECT *, 'lineitem.parquet' AS source_file FROM lineitem", ())
def src_parquet(spark, sf):
    schema = table(spark, sf, "lineitem").schema
    return R.read_parquet(spark, sf, schema, pattern="lineitem.parquet")


@query("src_csv", f"SELECT {LAP_LIST} FROM laps")
def src_csv(spark, sf):
    """Laps written in the dialect with marked names and read back by schema."""
    rows, path = _laps(spark, sf), _new(spark, "csv")
    rows.withColumnsRenamed({"GranPrix": "#GranPrix", "Compound": "#Compound"}).write.option("header", True).csv(path)
    return R.read_csv(spark, path, rows.schema).drop("source_file")


@query("src_csv_named", "SELECT CAST(DriverNumber AS VARCHAR) AS DriverNumber, CAST(LapNumber AS VARCHAR) AS LapNumber, GranPrix FROM laps")
def src_csv_named(spark, sf):
    path = _new(spark, "csv")
    rows = _laps(spark, sf).select("DriverNumber", F.col("LapNumber").alias("#LapNumber"), F.col("GranPrix").alias("#GranPrix"))
    rows.write.option("header", True).csv(path)
    return R.read_csv_named(spark, path)


@query(
    "src_json_map",
    "SELECT n_name AS Location, CAST(3000 + n_nationkey * 137 AS INTEGER) AS length_m FROM nation",
    (),
)
def src_json_map(spark, sf):
    path = _new(spark, "json")
    entry = F.struct(F.col("n_name"), (F.lit(3000) + F.col("n_nationkey") * 137).alias("v"))
    nations = table(spark, sf, "nation").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("m"))
    nations.select(F.to_json("m")).coalesce(1).write.text(path)
    return R.read_json_map(spark, path).drop("file_order")


@query("src_laps_weather", "SELECT event_id, LapNumber FROM laps WHERE Year = 2020 AND GranPrix = 'Grand Prix 2'")
def src_laps_weather(spark, sf):
    path = _new(spark, "landed")
    W.write_consolidated(role(spark, sf, "laps"), path)
    return R.session_rows(spark.read.parquet(path), 2020, "Grand Prix 2").select("event_id", "LapNumber")


@query(
    "src_session",
    """SELECT 'laps' AS source, event_id, LapNumber, Time, CAST(NULL AS DOUBLE) AS AirTemp FROM laps WHERE Year = 2020 AND GranPrix = 'Grand Prix 2'
    UNION ALL SELECT 'weather', event_id, NULL, Time, AirTemp FROM weather WHERE Year = 2020 AND GranPrix = 'Grand Prix 2'""",
    ("laps", "weather"),
)
def src_session(spark, sf):
    """A session's laps and weather, landed as two tables and read together."""
    paths = {}
    for name in ("laps", "weather"):
        paths[name] = _new(spark, name)
        W.write_consolidated(role(spark, sf, name), paths[name])
    session = R.read_session(spark, paths, 2020, "Grand Prix 2")
    columns = ["event_id", "LapNumber", "Time", "AirTemp"]
    return R.union_sources({n: df.select(*[c for c in columns if c in df.columns]) for n, df in session.items()}).select("source", *columns)


@query(
    "src_roster_map",
    """SELECT Year, Abbreviation AS Driver, count(*) AS races FROM results WHERE Year IN (2019, 2020)
        AND Abbreviation IN ('D1', 'D2', 'D8', 'D9', 'D15', 'D16') AND (Year = 2019 OR Abbreviation <> 'D1') GROUP BY ALL""",
    ("results",),
)
def src_roster_map(spark, sf):
    """Races of the drivers that a fixed roster names for their season."""
    six = ["D1", "D2", "D8", "D9", "D15", "D16"]
    fixed = C.roster_from_map(spark, {2019: six, 2020: six[1:]})
    results = role(spark, sf, "results").select("Year", F.col("Abbreviation").alias("Driver"))
    return join_small(results, fixed, ["Year", "Driver"], "left_semi").groupBy("Year", "Driver").agg(F.count("*").alias("races"))


@query("src_schedule", "SELECT * FROM schedule WHERE EventFormat = 'conventional'", ("schedule",))
def src_schedule(spark, sf):
    return C.conventional(role(spark, sf, "schedule"))


@query(
    "src_schedule_first",
    """SELECT * FROM schedule WHERE EventFormat = 'conventional'
    QUALIFY row_number() OVER (PARTITION BY Year ORDER BY RoundNumber, EventName) <= 3""",
    ("schedule",),
)
def src_schedule_first(spark, sf):
    return C.conventional(role(spark, sf, "schedule"), first=3)


@query("src_schedule_session5", "SELECT * FROM schedule WHERE Session5 = 'Race'", ("schedule",))
def src_schedule_session5(spark, sf):
    return C.session5_races(role(spark, sf, "schedule"))


@query(
    "src_race_list",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS Year, o_orderpriority AS Location FROM orders EXCEPT ALL
    SELECT CAST(year(o_orderdate) AS INTEGER), o_orderpriority FROM orders WHERE o_orderstatus = 'F'""",
    (),
)
def src_race_list(spark, sf):
    year = F.year("o_orderdate").alias("Year")
    orders = table(spark, sf, "orders")
    listed = orders.select(year, F.col("o_orderpriority").alias("Location"))
    removed = orders.where("o_orderstatus = 'F'").select(year, F.col("o_orderpriority").alias("Location"))
    return C.race_list(listed, removed)


@query("src_available", "SELECT DISTINCT EventName FROM schedule WHERE Year = 1996", ("schedule",))
def src_available(spark, sf):
    return C.available_events(role(spark, sf, "schedule"), 1996)


@query(
    "src_available_drivers",
    "SELECT DISTINCT DriverNumber, Abbreviation FROM results WHERE Year = 2021 AND GranPrix = 'Grand Prix 1'",
    ("results",),
)
def src_available_drivers(spark, sf):
    return C.available_drivers(role(spark, sf, "results"), 2021, "Grand Prix 1")


@query("src_rosters", "SELECT DISTINCT Year, Abbreviation AS Driver FROM results", ("results",))
def src_rosters(spark, sf):
    return C.roster(role(spark, sf, "results"))


@query(
    "src_filename_cols",
    """SELECT event_id, Year, RoundNumber, GranPrix AS EventName FROM laps""",
)
def src_filename_cols(spark, sf):
    event = F.replace("GranPrix", F.lit(" "), F.lit("_"))
    name = F.concat(file_name(), F.lit("_"), event, F.lit(".parquet"))
    laps = role(spark, sf, "laps").select("event_id", name.alias("source_file"))
    return laps.withColumns(R.race_file_columns()).drop("source_file")


@query(
    "src_filename_cols_driver",
    "SELECT event_id, CAST(DriverNumber AS INTEGER) AS DriverID, GranPrix AS EventName, Location, Year, 'tire_live_data' AS DataType FROM laps",
)
def src_filename_cols_driver(spark, sf):
    name = F.concat_ws(
        "_", F.col("DriverNumber").cast("string"), "GranPrix", F.lit("lives"), "Location", F.col("Year").cast("string"), F.lit("tire_live_data.csv")
    )
    laps = role(spark, sf, "laps").select("event_id", name.alias("source_file"))
    return laps.withColumns(R.driver_file_columns()).drop("source_file")


@query(
    "src_rename",
    "SELECT event_id, LapNumber, Driver, Compound, TyreLife, LapTime FROM laps",
)
def src_rename(spark, sf):
    laps = role(spark, sf, "laps").select(
        "event_id",
        F.col("LapNumber").alias("lap_number"),
        F.col("Driver").alias("driver_name"),
        F.col("Compound").alias("compound"),
        F.col("TyreLife").alias("tyre_life"),
        F.col("LapTime").alias("laptime"),
    )
    return R.standard_names(laps)


@query(
    "src_union_sources",
    """SELECT Year, GranPrix, LapNumber, LapTime, CAST(NULL AS DOUBLE) AS AirTemp, 'laps' AS source FROM laps UNION ALL
    SELECT Year, GranPrix, NULL, NULL, AirTemp, 'weather' FROM weather""",
    ("laps", "weather"),
)
def src_union_sources(spark, sf):
    laps = role(spark, sf, "laps").select("Year", "GranPrix", F.col("LapNumber").alias("lap_number"), F.col("LapTime").alias("lap_time"))
    weather = role(spark, sf, "weather").select("Year", "GranPrix", F.col("AirTemp").alias("air_temp"))
    return R.union_sources({"laps": laps, "weather": weather})


def _landed_sources(spark, sf):
    """Two folders of race files, one of them with a file that is none and one without rows; a third is not there."""
    path, laps = _new(spark, "sources"), role(spark, sf, "laps").select(*LAP_COLUMNS, "Driver")
    for name, rule in (("early", "Year < 2021"), ("late", "Year >= 2020")):
        laps.where(rule).write.parquet(f"{path}/{name}")
    laps.where("false").coalesce(1).write.parquet(f"{path}/late/none")
    spark.createDataFrame([("no table",)], "value string").coalesce(1).write.text(f"{path}/late/broken")
    return {"early": (f"{path}/early", "*.parquet"), "late": (f"{path}/late", "part-*"), "lost": (f"{path}/lost", "*")}, laps.schema


@query(
    "src_rejected_files",
    "SELECT 'late' AS source, 'empty' AS reason, CAST(1 AS BIGINT) AS files UNION ALL SELECT 'late', 'unreadable', 1 "
    "UNION ALL SELECT 'lost', 'missing', 1",
)
def src_rejected_files(spark, sf):
    sources, schema = _landed_sources(spark, sf)
    rejects = R.read_sources(spark, sources, schema)[1]
    return rejects.groupBy("source", "reason").agg(F.count("*").alias("files"))


@query(
    "unify_sources",
    """SELECT Year, GranPrix, DriverNumber, LapNumber, LapTime, CASE WHEN Year < 2021 THEN 'early' ELSE 'late' END AS source FROM laps""",
)
def unify_sources(spark, sf):
    """Laps of both sources once, the season that both have from the first."""
    sources, schema = _landed_sources(spark, sf)
    done = unify.unify(spark, sources, schema, ["Year", "GranPrix", "DriverNumber", "LapNumber"], min_rows=1)
    return done.rows.select("Year", "GranPrix", "DriverNumber", "LapNumber", "LapTime", "source")


# -- incremental -----------------------------------------------------------

_RACES = "r AS (SELECT DISTINCT Year, RoundNumber, GranPrix AS EventName FROM laps)"


def _races(spark, sf):
    return role(spark, sf, "laps").select("Year", "RoundNumber", F.col("GranPrix").alias("EventName")).distinct()


@query("src_incremental", f"{_RACES} SELECT * FROM r WHERE NOT (Year < 2021 AND RoundNumber <= 3)")
def src_incremental(spark, sf):
    races, path = _races(spark, sf), _new(spark, "manifest")
    I.record(races.where("Year < 2021 and RoundNumber <= 3"), path)
    return I.pending(races, I.read_manifest(spark, path))


@query(
    "set_except",
    f"SELECT DISTINCT {FILE_SQL} AS file FROM laps EXCEPT SELECT {FILE_SQL} FROM laps WHERE Year < 2021 AND RoundNumber <= 3",
)
def set_except(spark, sf):
    """Files that are there minus those a manifest names."""
    files = role(spark, sf, "laps").select("Year", "RoundNumber", F.col("GranPrix").alias("EventName"), file_name().alias("file"))
    path = _new(spark, "manifest")
    I.record(files.where("Year < 2021 and RoundNumber <= 3"), path)
    return files.select("file").subtract(I.read_manifest(spark, path).select(file_name().alias("file")))


@query(
    "src_incremental_progress",
    f"""{_RACES} SELECT count(*) AS planned, count(*) FILTER (Year < 2021) AS completed,
        round(count(*) FILTER (Year < 2021) * 100 / count(*), 6) AS pct FROM r""",
)
def src_incremental_progress(spark, sf):
    races, path = _races(spark, sf), _new(spark, "manifest")
    I.record(races.where("Year < 2021"), path)
    return I.progress(races, I.read_manifest(spark, path)).withColumn("pct", F.round("pct", 6))


_CORRECTED = f"""n AS (SELECT {LAP_LIST} FROM laps),
    c AS (SELECT * REPLACE (LapTime + CASE WHEN RoundNumber = 2 THEN 1 ELSE 0 END AS LapTime) FROM n WHERE RoundNumber <> 2 OR LapNumber > 1)"""


def _corrected(rows):
    """Round 2 as it is extracted again: a second more a lap, and the first lap gone."""
    again = rows.where("RoundNumber = 2 and LapNumber > 1")
    return again.withColumn("LapTime", F.col("LapTime") + 1)


@query(
    "src_incremental_corrected",
    f"{_CORRECTED} SELECT c.*, count(*) OVER (PARTITION BY Year, RoundNumber) AS noted, CAST(0 AS BIGINT) AS still_to_do FROM c",
)
def src_incremental_corrected(spark, sf):
    """All races land; round 2 lands again, corrected, with a failure between its rows and its lines in the manifest."""
    target, manifest, rows = _new(spark, "landed"), _new(spark, "manifest"), _laps(spark, sf)
    I.land_races(rows, target, manifest)
    I.overwrite_races(_corrected(rows), target)  # and then the job is lost
    I.land_changed(_corrected(rows), target, manifest)
    left = I.changed(_corrected(rows), I.read_landed(spark, manifest)).agg(F.count("*").alias("n"))
    noted = I.read_landed(spark, manifest).select("Year", "RoundNumber", F.col("n_rows").alias("noted"))
    return spark.read.parquet(target).select(*LAP_COLUMNS).join(noted, ["Year", "RoundNumber"]).withColumn("still_to_do", left.scalar())


@query("src_incremental_corrected_stream", f"{_CORRECTED} SELECT * FROM c")
def src_incremental_corrected_stream(spark, sf):
    """Race files taken up by a streaming run, then corrected files by a second one that resumes at its checkpoint."""
    rows = _laps(spark, sf)
    landing, target, manifest, checkpoint = (_new(spark, n) for n in ("landing", "target", "manifest", "checkpoint"))
    for part in (rows, _corrected(rows)):
        part.hint("rebalance", "Year", "RoundNumber").sortWithinPartitions("Year", "RoundNumber").coalesce(1).write.mode("append").parquet(landing)
        ingest.ingest_corrected(spark, landing, rows.schema, target, manifest, checkpoint).awaitTermination()
    return spark.read.parquet(target).select(*LAP_COLUMNS)


@query("src_incremental_stream", f"SELECT {LAP_LIST}, {FILE_SQL} AS race_file FROM laps")
def src_incremental_stream(spark, sf):
    """Race files of the first seasons, then of all others, each taken up once by a streaming run."""
    rows = _laps(spark, sf).withColumn("race_file", file_name())
    landing, target, checkpoint = (_new(spark, n) for n in ("landing", "target", "checkpoint"))
    for part in ("Year < 2021", "Year >= 2021"):
        rows.where(part).write.mode("append").parquet(landing)
        stream = ingest.file_stream(spark, landing, rows.schema)
        ingest.ingest_available(stream.drop("source_file", "EventName"), target, checkpoint).awaitTermination()
    return spark.read.parquet(target).drop("batch")


@query(
    "src_event_log",
    """SELECT source, count(*) AS lines FROM (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents)
    WHERE regexp_matches(lower(line), 'tion|ment') GROUP BY source""",
    (),
)
def src_event_log(spark, sf):
    """Lines that mention one of two words, in log files by source."""
    path = _new(spark, "logs")
    lines = table(spark, sf, "documents").select("source", F.explode(F.split("text", "\n")).alias("value"))
    lines.write.partitionBy("source").option("lineSep", "\n").text(path)
    return R.log_events(R.read_log(spark, path), keys=["source"], words=("tion", "ment"))


@query(
    "src_event_gaps",
    """SELECT s.* FROM schedule s ANTI JOIN laps l ON l.Year = s.Year + 22 AND l.GranPrix = s.EventName""",
    ("schedule", "laps"),
)
def src_event_gaps(spark, sf):
    laps = role(spark, sf, "laps").withColumn("Year", F.col("Year") - 22)
    return R.events_without_data(role(spark, sf, "schedule"), laps).select(*role(spark, sf, "schedule").columns)


# -- sinks -----------------------------------------------------------------


@query("sink_parquet", f"SELECT {LAP_LIST} FROM laps")
def sink_parquet(spark, sf):
    path = _new(spark, "consolidated")
    W.write_consolidated(_laps(spark, sf), path)
    return spark.read.parquet(path).select(*LAP_COLUMNS)


@query("sink_race_files", f"SELECT {LAP_LIST}, {FILE_SQL} || '_' || replace(GranPrix, ' ', '_') AS race_file FROM laps")
def sink_race_files(spark, sf):
    path = _new(spark, "races")
    W.write_race_files(_laps(spark, sf), path, event="GranPrix")
    return spark.read.parquet(path).select(*LAP_COLUMNS, "race_file")


@query(
    "sink_driver_csv",
    "SELECT CAST(DriverNumber AS INTEGER) AS DriverID, GranPrix, Year, LapNumber, LapTime FROM laps",
)
def sink_driver_csv(spark, sf):
    """One folder per (car, race, season)."""
    path = _new(spark, "drivers")
    rows = _laps(spark, sf).select(F.col("DriverNumber").cast("int").alias("DriverID"), "GranPrix", "Year", "LapNumber", "LapTime")
    W.write_driver_csv(rows, path)
    read = W.read_driver_csv(spark, path, "LapNumber int, LapTime double, DriverID int, GranPrix string, Year int")
    return read.select("DriverID", "GranPrix", "Year", "LapNumber", "LapTime")


@query(
    "sink_splits",
    """SELECT GlobalLapID, CASE WHEN Year < 2022 THEN 'train' WHEN Year = 2023 THEN 'val' ELSE 'test' END AS split
    FROM targeted WHERE Year <> 2022""",
    ("targeted",),
)
def sink_splits(spark, sf):
    path = _new(spark, "splits")
    W.write_splits(M.split_years(role(spark, sf, "targeted")), path, ["LapTime", "TyreLife"])
    return spark.read.parquet(f"{path}/data").select("GlobalLapID", "split")


@query("sink_report", "SELECT Year, GranPrix, CAST(max(LapNumber) AS BIGINT) AS total_laps FROM laps GROUP BY ALL")
def sink_report(spark, sf):
    path = _new(spark, "report")
    W.write_report(S.total_laps(role(spark, sf, "laps")), path)
    return spark.read.schema("Year int, GranPrix string, total_laps bigint").json(path)


@query("sink_dry_run", "SELECT count(*) AS rows FROM laps")
def sink_dry_run(spark, sf):
    laps = role(spark, sf, "laps")
    W.dry_run(N.time_deltas(laps))
    return laps.agg(F.count("*").alias("rows"))


# -- order and limits ------------------------------------------------------


@query("sort_chrono", "SELECT Year, GranPrix, Driver, LapNumber, LapTime FROM laps ORDER BY 1, 2, 3, 4")
def sort_chrono(spark, sf):
    return role(spark, sf, "laps").select("Year", "GranPrix", "Driver", "LapNumber", "LapTime").orderBy(
        "Year", "GranPrix", "Driver", "LapNumber"
    )


@query("sort_results", "SELECT * FROM results ORDER BY Year, GranPrix, Position NULLS LAST, DriverNumber", ("results",))
def sort_results(spark, sf):
    return role(spark, sf, "results").orderBy("Year", "GranPrix", F.asc_nulls_last("Position"), "DriverNumber")


@query("topk_finishers", "SELECT Year, GranPrix, Position, Abbreviation FROM results WHERE Position <= 10", ("results",))
def topk_finishers(spark, sf):
    return role(spark, sf, "results").where("Position <= 10").select("Year", "GranPrix", "Position", "Abbreviation")


# -- model -----------------------------------------------------------------

FEATURES = ["LapTime", "TyreLife", "TrackTemp", "Position", "LapNumber"]


def _modelled(spark, sf):
    rows, names = tyre_model.window_features(role(spark, sf, "targeted"), FEATURES)
    split = M.split_years(rows)
    return tyre_model.train_change(split.where("split = 'train'"), names), split


@query("ml_train_baseline")
def ml_train_baseline(spark, sf):
    model, split = _modelled(spark, sf)
    scored = tyre_model.score(model, split.where("split <> 'train'"))
    return scored.select("GlobalLapID", "split", "tire_change_next_lap", "prob")


@query(
    "ml_score",
    """SELECT 'driver' AS asked, GlobalLapID, true AS in_range, true AS alike FROM targeted WHERE Year = 2024 AND Driver = 'D6'
    UNION ALL SELECT 'circuit', GlobalLapID, true, true FROM targeted WHERE Year = 2024 AND Location = 'NATION_5'""",
    ("targeted",),
)
def ml_score(spark, sf):
    """A saved model on a driver's season and on a circuit: probabilities in range and those of the live model."""
    model, split = _modelled(spark, sf)
    path = _new(spark, "model")
    model.save(path)
    live = tyre_model.score(model, split).select("GlobalLapID", F.col("prob").alias("live"))
    asked = {"driver": {"driver": "D6"}, "circuit": {"location": "NATION_5"}}
    parts = [
        tyre_model.score_session(path, split, year=2024, **what).select(F.lit(name).alias("asked"), "GlobalLapID", "prob")
        for name, what in asked.items()
    ]
    both = parts[0].unionByName(parts[1]).join(live, "GlobalLapID")
    return both.select(
        "asked", "GlobalLapID", F.col("prob").between(0, 1).alias("in_range"), (F.abs(F.col("prob") - F.col("live")) < 1e-12).alias("alike")
    )


# -- two heads, saved and loaded ---------------------------------------------

_saved: dict[tuple[str, str], str] = {}


def _heads(spark, sf):
    """Both heads fitted on the training seasons, saved once a session, and loaded."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _saved:
        path, train = _new(spark, "heads"), M.split_years(role(spark, sf, "targeted")).where("split = 'train'")
        tyre_model.train_heads(train, SEQ_ALL).save(path)
        _saved[key] = path
    return PipelineModel.load(_saved[key])


def _scored_columns(split):
    """What the heads read and the reports look at, so that no other column is sorted and staged with the scores."""
    return split.select(*dict.fromkeys(["split", *M.CAR_ID, "LapNumber", *SEQ_ALL, "Compound", "next_tire_type", tyre_model.TARGET]))


@query(
    "ml_two_heads",
    f"""{SPLIT_SQL}, t AS (SELECT * FROM split WHERE split = 'train')
    SELECT 'change' AS head, 'weighted' AS name, 0.5::DOUBLE AS share
    UNION ALL SELECT 'type', next_tire_type, round(count(*)::DOUBLE / sum(count(*)) OVER (), 3) FROM t
    WHERE tire_change_next_lap = 1 AND next_tire_type IN (SELECT Compound FROM t) GROUP BY next_tire_type""",
    ("targeted",),
)
def ml_two_heads(spark, sf):
    """Mean probabilities of the loaded model on its training laps: with classes weighed alike one half, by compound its share."""
    model, split = _heads(spark, sf), _scored_columns(M.split_years(role(spark, sf, "targeted")))
    scored = stage(tyre_model.score_heads(model, split.where("split = 'train'")), "scored")
    target = tyre_model.TARGET
    weights = M.class_weights(scored, target).select(F.col("class").alias(target), "weight")
    mean = (F.sum(F.col("prob") * F.col("weight")) / F.sum("weight")).alias("share")
    change = scored.join(F.broadcast(weights), target).agg(mean)  # two rows
    codes = tyre_model.compounds(model)
    learnt = scored.where(F.col(target) == 1).join(codes, F.col("next_tire_type") == F.col("value"), "left_semi")
    kinds = learnt.select(F.posexplode("type_probs").alias("code", "p")).groupBy("code").agg(F.avg("p").alias("share"))
    kinds = kinds.join(codes, "code").select(F.lit("type").alias("head"), F.col("value").alias("name"), "share")
    both = change.select(F.lit("change").alias("head"), F.lit("weighted").alias("name"), "share").unionByName(kinds)
    return both.withColumn("share", F.round("share", 3)).where("share > 0")


@query(
    "ml_model_report",
    f"""{SPLIT_SQL} SELECT split, count(*) FILTER (tire_change_next_lap = 1) AS changes, count(*) FILTER (tire_change_next_lap = 0) AS others,
        true AS rates_in_range, true AS area_in_range, count(DISTINCT next_tire_type) FILTER (tire_change_next_lap = 1
            AND next_tire_type IN (SELECT Compound FROM split WHERE split = 'train')) AS types_reported
    FROM split WHERE split <> 'train' GROUP BY split""",
    ("targeted",),
)
def ml_model_report(spark, sf):
    """Confusion, area and report by compound of the loaded model on the seasons it has not seen."""
    model, split = _heads(spark, sf), _scored_columns(M.split_years(role(spark, sf, "targeted")))
    scored = stage(tyre_model.score_heads(model, split.where("split <> 'train'")), "scored")
    codes = tyre_model.compounds(model).select(F.col("value").alias("next_tire_type"), F.col("code").alias("type_true"))
    parts = []
    for name in ("val", "test"):
        rows = scored.where(F.col("split") == name).withColumn("y", F.col(tyre_model.TARGET))
        seen = rows.where("y = 1").join(codes, "next_tire_type")
        counted = ME.confusion(rows).select((F.col("tp") + F.col("fn")).alias("changes"), (F.col("tn") + F.col("fp")).alias("others"), "recall", "precision")
        area = ME.roc_auc(rows).select(F.col("roc_auc").alias("_area")).scalar()
        report = ME.type_report(seen).where("support > 0").agg(F.count("*").alias("n")).scalar()
        in_range = F.col("recall").between(0, 1) & F.col("precision").between(0, 1)
        parts.append(
            counted.select(
                F.lit(name).alias("split"), "changes", "others", in_range.alias("rates_in_range"), area.between(0, 1).alias("area_in_range"), report.alias("types_reported")
            )
        )
    return parts[0].unionByName(parts[1])


@query("ml_score_requests")
def ml_score_requests(spark, sf):
    """Raw laps by season through the loaded model for requests that the results table makes: a driver, a circuit, or both."""
    path = _new(spark, "seasons")
    W.write_consolidated(role(spark, sf, "targeted"), path)
    cars = role(spark, sf, "laps").where("Year = 2024").select("Year", "Driver", "Location").distinct()
    one = F.col("Driver").isin("D6", "D13", "D27")
    asked = cars.select(
        F.xxhash64("Year", "Driver", "Location").alias("request_id"), "Year", F.when(one, F.col("Driver")).alias("Driver"), F.when(~one, F.col("Location")).alias("Location")
    )
    return tyre_model.score_requests(_heads(spark, sf), spark.read.parquet(path), asked.dropDuplicates(["Year", "Driver", "Location"])).drop("type_probs")


# -- learning data in buckets --------------------------------------------------

_STORED = ["LapTime", "TyreLife", "TrackTemp"]


def _stored_sql() -> str:
    def scaled(c):
        q = [f"(SELECT quantile_cont(CAST({c} AS DOUBLE), {p}) FROM split WHERE split = 'train')" for p in (0.25, 0.5, 0.75)]
        return f"CAST(({c} - {q[1]}) / CASE WHEN {q[2]} = {q[0]} THEN 1 ELSE {q[2]} - {q[0]} END AS FLOAT) AS {c}"

    codes = """codes AS (SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS code
        FROM (SELECT DISTINCT coalesce(Compound, 'nan') AS value FROM split WHERE split = 'train' UNION SELECT 'NO_CHANGE'))"""
    names = [*_STORED, "Compound_encoded"]
    return f"""{SPLIT_SQL}, {codes}, n AS (SELECT split, DriverRaceID, LapNumber, tire_change_next_lap, {", ".join(scaled(c) for c in _STORED)},
        CAST(k.code AS FLOAT) AS Compound_encoded, y.code AS y_type, row_number() OVER (PARTITION BY DriverRaceID ORDER BY LapNumber) AS i
        FROM split LEFT JOIN codes k ON k.value = coalesce(Compound, 'nan') LEFT JOIN codes y ON y.value = coalesce(next_tire_type, 'nan'))
    SELECT e.split, e.DriverRaceID, e.LapNumber, CAST(s.i - e.i + 9 AS INTEGER) AS step, {", ".join(r6_sql(f"s.{c}") + f" AS {c}" for c in names)},
        e.tire_change_next_lap AS y_change, e.y_type
    FROM n e JOIN n s ON s.DriverRaceID = e.DriverRaceID AND s.i BETWEEN e.i - 9 AND e.i WHERE e.i >= 10"""


@query("sink_split_sequences", _stored_sql(), ("targeted",))
def sink_split_sequences(spark, sf):
    """Splits, codes, quartiles and features written in buckets of the car; sequences made of what is read back."""
    path = _new(spark, "learning")
    learning_store.save(lap_dataset.prepare(X.compound_strategy(role(spark, sf, "targeted"))), path, buckets=8)
    stored, parts = learning_store.load(spark, path), []
    for split in learning_store.SPLITS:
        rows = stored.made_sequences(split).select(F.lit(split).alias("split"), "*", F.posexplode("X").alias("step", "row"))
        cols = [r6(F.get("row", F.lit(stored.features.index(c)))).alias(c) for c in [*_STORED, "Compound_encoded"]]
        parts.append(rows.select("split", "DriverRaceID", "LapNumber", "step", *cols, "y_change", "y_type"))
    return reduce(DataFrame.unionByName, parts)
