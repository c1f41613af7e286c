"""Profiles, validation, duplicates and quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlake.functions.joins import join_small

ESSENTIAL = ["Year", "DriverID", "LapNumber", "Position", "LapTime"]


def _long(wide: DataFrame, names: list[str], fields: dict[str, str]) -> DataFrame:
    """One aggregate row with ``<field>_<i>`` columns as one row per name."""
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("column"), *[F.col(f"{f}_{i}").cast(t).alias(f) for f, t in fields.items()])
            for i, n in enumerate(names)
        ]
    )
    extra = [c for c in wide.columns if c.startswith("all_")]
    return wide.select(*extra, F.explode(rows).alias("_r")).select(*extra, "_r.*")


# -- profiles --------------------------------------------------------------


def year_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("Year").agg(
        F.count_distinct("RaceID").alias("races"),
        F.count_distinct("DriverID").alias("drivers"),
        F.count("LapNumber").alias("laps"),
    )


def missing_profile(df: DataFrame) -> DataFrame:
    """Columns with missing values, most first, with their share in percent."""
    wide = df.agg(
        F.count("*").alias("all_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{i}") for i, c in enumerate(df.columns)],
    )
    long = _long(wide, df.columns, {"missing": "long"}).where(F.col("missing") > 0)
    pct = F.round(F.col("missing") / F.col("all_rows") * 100, 2)
    return long.select("column", "missing", pct.alias("pct")).orderBy(F.desc("missing"), "column")


def top_missing(df: DataFrame, n: int = 10) -> DataFrame:
    return missing_profile(df).limit(n)


def duplicates(df: DataFrame) -> DataFrame:
    """How many rows repeat another one in full."""
    distinct = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return distinct.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
    )


def ranges(df: DataFrame, columns: list[str]) -> DataFrame:
    wide = df.agg(
        *[F.min(c).alias(f"min_{i}") for i, c in enumerate(columns)],
        *[F.max(c).alias(f"max_{i}") for i, c in enumerate(columns)],
    )
    return _long(wide, columns, {"min": "double", "max": "double"})


def value_counts_pct(df: DataFrame, column: str) -> DataFrame:
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("t"))
    return counts.withColumn("pct", F.col("n") * 100 / total.scalar())


def stint_stats(df: DataFrame) -> DataFrame:
    """Tyre life per stint number, and overall in the row with a null stint."""
    return (
        df.where(F.col("Stint").isNotNull())
        .rollup("Stint")
        .agg(F.count("TyreLife").alias("n"), F.avg("TyreLife").alias("mean"), F.max("TyreLife").alias("max"))
    )


def pit_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if("PitInTime").alias("pit_stops"))


def target_balance(df: DataFrame) -> DataFrame:
    """Tyre changes, other laps, share and the ``1:n`` ratio."""
    changes = F.sum("tire_change_next_lap")
    return df.agg(changes.cast("long").alias("changes"), (F.count("*") - changes).cast("long").alias("others")).select(
        "changes",
        "others",
        (F.col("changes") * 100 / (F.col("changes") + F.col("others"))).alias("pct"),
        F.try_divide("others", "changes").alias("ratio"),
    )


def type_balance(df: DataFrame) -> DataFrame:
    """Next compounds of the laps with a change."""
    return df.where("tire_change_next_lap = 1").groupBy("next_tire_type").agg(F.count("*").alias("n"))


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """Known values, their share in percent and their mean per column."""
    wide = df.agg(
        F.count("*").alias("all_rows"),
        *[F.count(c).alias(f"known_{i}") for i, c in enumerate(columns)],
        *[F.avg(F.col(c).cast("double")).alias(f"mean_{i}") for i, c in enumerate(columns)],
    )
    long = _long(wide, columns, {"known": "long", "mean": "double"})
    return long.select("column", "known", (F.col("known") * 100 / F.col("all_rows")).alias("pct"), "mean")


def histogram(df: DataFrame, value: str, bins: int = 50, by: list[str] | None = None) -> DataFrame:
    """Counts in equal-width bins between the smallest and largest value, the last one closed."""
    known = df.where(F.col(value).isNotNull())
    ends = known.agg(
        F.struct(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi")).alias("e")
    )
    part = F.try_divide(F.col(value) - F.col("_e.lo"), F.col("_e.hi") - F.col("_e.lo"))
    slot = F.least(F.floor(F.coalesce(part, F.lit(0.0)) * bins), F.lit(bins - 1)).cast("int")
    return known.withColumn("_e", ends.scalar()).groupBy(*(by or []), slot.alias("bin")).agg(F.count("*").alias("n"))


# -- validation ------------------------------------------------------------


def validate(df: DataFrame, file: str = "file") -> DataFrame:
    """Per file: sizes, key ranges, missing cells and an array of issues."""
    absent = [c for c in ESSENTIAL if c not in df.columns]
    data = [c for c in df.columns if c != file]
    has = set(df.columns)

    def if_there(c: str, col: Column, other) -> Column:
        return col if c in has else F.lit(other)

    nulls = sum((F.col(c).isNull().cast("long") for c in data), F.lit(0).cast("long"))
    stats = df.groupBy(file).agg(
        F.count("*").alias("n_rows"),
        F.lit(len(data)).alias("n_columns"),
        if_there("DriverID", F.count_distinct("DriverID"), 0).alias("n_drivers"),
        if_there("LapNumber", F.count_distinct("LapNumber"), 0).alias("n_laps"),
        F.sum(nulls).alias("missing_values"),
        if_there("Year", F.array_sort(F.collect_set("Year")), None).alias("years"),
        if_there("GranPrix", F.array_sort(F.collect_set("GranPrix")), None).alias("gran_prix"),
        if_there("LapNumber", F.count_if(F.col("LapNumber") <= 0), 0).alias("_bad_lap"),
        if_there("Position", F.count_if(F.col("Position") <= 0), 0).alias("_bad_position"),
    )
    keys = ["Year", "DriverID", "LapNumber"]
    if set(keys) <= has:
        repeated = (
            df.dropna(subset=keys)
            .groupBy(file, *keys)
            .agg(F.count("*").alias("_n"))
            .where(F.col("_n") > 1)
            .groupBy(file)
            .agg(F.count("*").alias("_repeated"))
        )
        stats = stats.join(repeated, file, "left")
    else:
        stats = stats.withColumn("_repeated", F.lit(0))
    issues = F.array_compact(
        F.array(
            F.lit(f"missing columns: {', '.join(absent)}" if absent else None),
            F.when(F.col("_bad_lap") > 0, F.lit("LapNumber <= 0")),
            F.when(F.col("_bad_position") > 0, F.lit("Position <= 0")),
            F.when(
                F.col("_repeated") > 0, F.concat(F.col("_repeated").cast("string"), F.lit(" repeated key groups"))
            ),
        )
    )
    return stats.withColumn("issues", issues).drop("_bad_lap", "_bad_position", "_repeated")


def quality_gate(df: DataFrame, file: str = "file", max_missing_pct: float = 30.0, min_rows: int = 100) -> DataFrame:
    """Per file: rows, missing cells in percent, whether to warn and whether to accept it."""
    data = [c for c in df.columns if c != file]
    nulls = sum((F.col(c).isNull().cast("long") for c in data), F.lit(0).cast("long"))
    return (
        df.groupBy(file)
        .agg(F.count("*").alias("n_rows"), (F.avg(nulls) * 100 / len(data)).alias("missing_pct"))
        .withColumns({"warn": F.col("missing_pct") > max_missing_pct, "accepted": F.col("n_rows") >= min_rows})
    )


def accepted_rows(df: DataFrame, gate: DataFrame, file: str = "file") -> DataFrame:
    return join_small(df, gate.where("accepted"), [file], "left_semi")


def consolidation_stats(df: DataFrame, file: str = "file", failed: DataFrame | None = None) -> DataFrame:
    """One row: files, rows, seasons, distinct drivers and races."""
    stats = df.agg(
        F.count_distinct(file).alias("files_ok"),
        F.count("*").alias("rows"),
        F.array_join(F.transform(F.array_sort(F.collect_set("Year")), lambda y: y.cast("string")), ",").alias("years"),
        F.count_distinct("DriverID").alias("drivers"),
        F.count_distinct("Year", "GranPrix").alias("races"),
    )
    bad = failed.agg(F.count_distinct(file).alias("n")).scalar() if failed is not None else F.lit(0).cast("long")
    return stats.withColumn("files_failed", bad)


def unify_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows and columns of the unified table, its range, and how many rows were duplicates."""
    n = before.agg(F.count("*").alias("n")).scalar()
    return after.agg(
        F.count("*").alias("rows"),
        F.lit(len(after.columns)).alias("columns"),
        F.min("Year").alias("first_year"),
        F.max("Year").alias("last_year"),
        F.count_distinct("Driver").alias("drivers"),
        F.count_distinct("Year", "GranPrix").alias("events"),
    ).withColumn("duplicates_removed", n - F.col("rows"))


# -- duplicates ------------------------------------------------------------


def dedupe_exact(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def dedupe_first(df: DataFrame, subset: list[str], order: list[str]) -> DataFrame:
    """The first row by ``order`` of every key; columns that are not there do not count as key.

    Keys are combined per task before the shuffle, so many copies of one row
    travel as one.
    """
    keys = [c for c in subset if c in df.columns]
    if not keys:
        return df
    others = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_first"))
    return first.select(*keys, "_first.*").select(*df.columns)


# -- quarantine ------------------------------------------------------------


def split_valid(df: DataFrame, rules: dict[str, tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Rows that break no rule, and the others with the ``level`` and ``reason`` of the first broken one.

    ``rules`` maps a reason to its level (``race``, ``driver``, ``lap``) and the
    condition of a bad row.
    """
    broken = F.array_compact(
        F.array(
            *[
                F.when(
                    F.coalesce(bad, F.lit(True)), F.struct(F.lit(level).alias("level"), F.lit(reason).alias("reason"))
                )
                for reason, (level, bad) in rules.items()
            ]
        )
    )
    marked = df.withColumn("_broken", F.get(broken, F.lit(0)))
    good = marked.where(F.col("_broken").isNull()).drop("_broken")
    bad = marked.where(F.col("_broken").isNotNull()).select(*df.columns, "_broken.*")
    return good, bad


def error_summary(rejected: DataFrame) -> DataFrame:
    """Rejected rows and the races they come from, by level and reason."""
    return rejected.groupBy("level", "reason").agg(
        F.count("*").alias("rows"), F.count_distinct("Year", "GranPrix").alias("races")
    )
