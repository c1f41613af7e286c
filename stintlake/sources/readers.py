"""Reading landed tables, CSV dialects, maps and logs."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stintlake.functions.joins import join_small
from stintlake.session import stage
from stintlake.sources.footers import FOOTER, footers, known_store

# Column names of other sources and the names used here.
ALIASES = {
    "lap_number": "LapNumber",
    "lapnumber": "LapNumber",
    "driver": "Driver",
    "driver_name": "Driver",
    "compound": "Compound",
    "tyre_life": "TyreLife",
    "tyrelife": "TyreLife",
    "position": "Position",
    "lap_time": "LapTime",
    "laptime": "LapTime",
    "sector_1_time": "Sector1Time",
    "sector_2_time": "Sector2Time",
    "sector_3_time": "Sector3Time",
    "track_status": "TrackStatus",
    "air_temp": "AirTemp",
    "humidity": "Humidity",
    "pressure": "Pressure",
    "rainfall": "Rainfall",
    "wind_direction": "WindDirection",
    "wind_speed": "WindSpeed",
}


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None, pattern: str | None = None):
    """All Parquet files below ``path`` in one scan, with their file name."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path).withColumn("source_file", F.col("_metadata.file_name"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, recursive: bool = False) -> DataFrame:
    """CSV files with a header; columns are matched by position to ``schema``, a byte-order mark is skipped."""
    reader = spark.read.option("header", True).option("enforceSchema", True).option("encoding", "UTF-8")
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.schema(schema).csv(path).withColumn("source_file", F.col("_metadata.file_name"))


def read_csv_named(spark: SparkSession, path: str) -> DataFrame:
    """CSV files of one header, as text columns under clean names.

    Marks that a header may carry (``#`` before a name, a byte-order mark) are
    taken off the names. Types are left to the caller's casts.
    """
    raw = spark.read.option("header", True).csv(path)
    names = [c.lstrip("﻿").lstrip("#") for c in raw.columns]
    return raw.toDF(*names)


def read_json_map(spark: SparkSession, path: str, key: str = "Location", value: str = "length_m") -> DataFrame:
    """Entries of a JSON object as rows with their place in the file; no rows when there is no file."""
    schema = T.StructType(
        [
            T.StructField(key, T.StringType()),
            T.StructField(value, T.IntegerType()),
            T.StructField("file_order", T.IntegerType()),
        ]
    )
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path):
        return spark.createDataFrame([], schema)
    text = spark.read.text(path, wholetext=True)
    entries = F.map_entries(F.from_json("value", "map<string,int>"))
    return text.select(F.posexplode(entries).alias("file_order", "_e")).select(
        F.col("_e.key").alias(key), F.col("_e.value").alias(value), "file_order"
    )


def standard_names(df: DataFrame, aliases: dict[str, str] = ALIASES) -> DataFrame:
    """Known aliases renamed, unless that would give one name to two columns."""
    taken = set(df.columns)
    names = {a: n for a, n in aliases.items() if a in taken and n not in taken}
    once = {}
    for a, n in names.items():
        if n not in once.values():
            once[a] = n
    return df.withColumnsRenamed(once)


def race_file_columns(file: Column | str = "source_file") -> dict[str, Column]:
    """Year, round and event out of ``{year}_{round}_{event}.parquet``."""
    name = F.col(file) if isinstance(file, str) else file
    pattern = r"^(\d{4})_(\d{1,2})_(.*?)(?:\.[A-Za-z]+)?$"
    part = [F.regexp_extract(name, pattern, i) for i in (1, 2, 3)]
    return {
        "Year": part[0].try_cast("int"),
        "RoundNumber": part[1].try_cast("int"),
        "EventName": F.nullif(F.replace(part[2], F.lit("_"), F.lit(" ")), F.lit("")),
    }


def driver_file_columns(file: Column | str = "source_file") -> dict[str, Column]:
    """Car, event, location, year and kind out of the names of per-driver CSV files.

    Names read ``{car}_{event}_lives|location_{location}_{year}_{kind}.csv``.
    """
    name = F.col(file) if isinstance(file, str) else file
    pattern = r"^(\d+)_(.+?)_(?:lives|location)_(.+)_(\d{4})_(.+)\.csv$"
    part = [F.nullif(F.regexp_extract(name, pattern, i), F.lit("")) for i in (1, 2, 3, 4, 5)]
    return {
        "DriverID": part[0].try_cast("int"),
        "EventName": part[1],
        "Location": part[2],
        "Year": part[3].try_cast("int"),
        "DataType": part[4],
    }


def union_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """All sources under standard names, missing columns null, tagged with their name."""
    tagged = [standard_names(df).withColumn("source", F.lit(name)) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


FILES = "source string, path string, file string, length long"


def _path_key(path: Column | str) -> Column:
    """A full path in one spelling: listings and rows differ in the slashes of local ones."""
    return F.regexp_replace(path, "^file:///", "file:/")


def _there(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def discover(spark: SparkSession, sources: dict[str, tuple[str, str]]) -> DataFrame:
    """Files by source: ``sources`` maps a name to a folder and a pattern of file names.

    Only names and lengths are listed; ``file`` is the full path as it stands in a row's metadata. A folder that does not
    exist gives one row with a null length. Files of no bytes, which a scan passes over, are there too.
    """
    found = []
    for name, (folder, pattern) in sources.items():
        if not _there(spark, folder):
            found.append(spark.createDataFrame([(name, folder, None, None)], FILES))
            continue
        listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
        scanned = listed.select(F.lit(name).alias("source"), "path", _path_key("_metadata.file_path").alias("file"), "length")
        names = spark.createDataFrame([(f, unquote(f)) for f in listed.inputFiles()], "_f string, _p string")
        names = names.select(_path_key("_f").alias("_f"), _path_key("_p").alias("_p"))
        bare = names.join(scanned, F.col("_f") == F.col("file"), "left_anti").select(F.lit(name), "_p", "_f", F.lit(0).cast("long"))
        found.append(scanned.union(bare))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], FILES)


def _counted(spark: SparkSession, files: DataFrame, sources: dict[str, tuple[str, str]], schema: T.StructType) -> DataFrame:
    """The index of files in stores that only Spark opens: row counts by a scan of no column, which reads footers alone.

    What gives no row is ``without rows``; whether it is broken or empty is not known.
    """
    counts = []
    for name, (folder, pattern) in sources.items():
        if _there(spark, folder):
            reader = spark.read.schema(schema).option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
            scan = reader.option("ignoreCorruptFiles", True).parquet(folder)
            counts.append(scan.select(F.lit(name).alias("source"), _path_key("_metadata.file_path").alias("file")).groupBy("source", "file").agg(F.count("*").alias("n_rows")))
    listed = files.where("length is not null")
    found = listed.join(reduce(DataFrame.unionByName, counts), ["source", "file"], "left") if counts else listed.withColumn("n_rows", F.lit(None).cast("long"))
    found = found.withColumn("reason", F.when(F.col("n_rows").isNull(), "without rows"))
    return spark.createDataFrame([], FOOTER).unionByName(found, allowMissingColumns=True)


def file_index(spark: SparkSession, sources: dict[str, tuple[str, str]], schema: T.StructType) -> DataFrame:
    """One row per file of all sources, and per folder that is ``missing``, as ``footers`` describes it; staged."""
    files = discover(spark, sources)
    near = {n: s for n, s in sources.items() if known_store(_qualified(spark, s[0]))}
    far = {n: s for n, s in sources.items() if n not in near}
    parts = [files.where("length is null").withColumn("reason", F.lit("missing"))]
    if near:
        parts.append(footers(files.where(F.col("length").isNotNull() & F.col("source").isin(*near))))
    if far:
        parts.append(_counted(spark, files.where(F.col("source").isin(*far)), far, schema))
    empty = spark.createDataFrame([], FOOTER)
    return stage(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [empty, *parts]), "files")


def _qualified(spark: SparkSession, folder: str) -> str:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _literal(path: str) -> str:
    """A path in which no character stands for others."""
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in path)


def read_files(spark: SparkSession, index: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows of the files of ``index`` that have no ``reason`` yet, and all others with theirs.

    Rows come under standard names with ``source``, ``source_file`` (the name), ``source_path`` (the full path) and
    ``source_row`` (the place in the file), read once and staged. A file that gives fewer rows than its footer has is
    rejected whole, as ``incomplete``, or as ``unreadable`` if it gives none. The list of files goes through the driver, as
    in every scan.
    """
    parts = []
    for source, files in index.where("reason is null").groupBy("source").agg(F.collect_list("path")).collect():
        rows = spark.read.schema(schema).option("ignoreCorruptFiles", True).parquet(*[_literal(p) for p in sorted(files)])
        rows = rows.withColumns({
            "source_file": F.col("_metadata.file_name"), "source_path": _path_key("_metadata.file_path"), "source_row": F.col("_metadata.row_index"),
        })
        parts.append(standard_names(rows).withColumn("source", F.lit(source)))
    tags = [T.StructField(n, T.StringType()) for n in ("source_file", "source_path")]
    plain = T.StructType([*schema.fields, *tags, T.StructField("source_row", T.LongType()), T.StructField("source", T.StringType())])
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else standard_names(spark.createDataFrame([], plain))
    rows = stage(rows, "sources")
    read = rows.groupBy("source", F.col("source_path").alias("file")).agg(F.count("*").alias("_read"))
    seen = index.join(read, ["source", "file"], "left")
    late = F.when(F.col("_read").isNull(), "unreadable").when(F.col("_read") < F.col("n_rows"), "incomplete")
    seen = stage(seen.withColumn("reason", F.coalesce("reason", late)).drop("_read"), "files")
    rejects = seen.where("reason is not null")
    broken = rejects.where(F.col("reason").isin("incomplete")).select("source", F.col("file").alias("source_path"))
    return join_small(rows, broken, ["source", "source_path"], "left_anti").select(*rows.columns), rejects


def read_sources(
    spark: SparkSession, sources: dict[str, tuple[str, str]], schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """Rows of all Parquet files that can be read to their end, and the other files with the reason.

    Rows come under standard names, tagged with ``source`` and ``source_file``. The footers of all files are read first
    (``file_index``): folders that are not there are ``missing``, files without a footer ``unreadable``, those without rows
    ``empty``; none of these is opened again. The rest is read once (``read_files``).
    """
    rows, rejects = read_files(spark, file_index(spark, sources, schema), schema)
    return rows.drop("source_path", "source_row"), rejects.select("source", "path", "reason")


def session_rows(table: DataFrame, year: int, event: str) -> DataFrame:
    """One session's rows of a landed table; prunes the scan on a table partitioned by year."""
    return table.where((F.col("Year") == year) & (F.col("GranPrix") == event))


def read_session(spark: SparkSession, paths: dict[str, str], year: int, event: str) -> dict[str, DataFrame]:
    """One session of several landed tables, such as its laps and its weather, under their names."""
    return {name: session_rows(spark.read.parquet(path), year, event) for name, path in paths.items()}


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files, with the columns their folders are named by."""
    return spark.read.option("lineSep", "\n").text(path)


def log_events(
    lines: DataFrame, line: str = "value", keys: list[str] | None = None, words: tuple[str, ...] = ("warning", "error")
) -> DataFrame:
    """Lines that mention one of ``words``, in lower case, counted per event."""
    low = F.lower(line)
    hits = lines.where(reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words]))
    return hits.groupBy(*(keys or [])).agg(F.count("*").alias("lines"))


def events_without_data(schedule: DataFrame, laps: DataFrame) -> DataFrame:
    """Scheduled events that no lap belongs to."""
    seen = laps.select("Year", F.col("GranPrix").alias("EventName"))
    return schedule.join(seen, ["Year", "EventName"], "left_anti")
