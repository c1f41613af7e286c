"""Circuit lengths and encodings joined to laps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlake.functions.joins import join_small
from stintlake.session import stage


def join_circuit(
    laps: DataFrame,
    circuits: DataFrame,
    location: str = "Location",
    length: str = "length_m",
    similar: bool = True,
    ignore_case: bool = False,
    places: DataFrame | None = None,
) -> DataFrame:
    """Laps with the length of their circuit, null where it is unknown.

    A location without an entry of its own takes the first circuit, by
    ``file_order``, whose name contains it or is contained in it. Names are
    matched on the distinct locations, taken from ``places`` when ``laps`` is
    costly to read twice; laps meet the result in an equi-join.
    """
    exact = circuits.select(F.col("Location").alias("_loc"), F.col(length).alias("_exact"))
    if not similar:
        return (
            join_small(laps, exact, F.col(location) == F.col("_loc"))
            .withColumn(length, F.col("_exact"))
            .drop("_loc", "_exact")
        )
    rows = laps if places is None else places
    places = rows.where(F.col(location).isNotNull()).select(F.col(location).alias("_place")).distinct()
    missing = stage(places.join(exact, F.col("_place") == F.col("_loc"), "left_anti"), "places")
    fold = F.lower if ignore_case else F.col
    near = circuits.select(fold("Location").alias("_name"), F.col(length).alias("_len"), "file_order")
    asked = missing.select("_place", fold("_place").alias("_name"))
    inside = containing(asked, near.withColumnsRenamed({"_name": "_whole"}), "_name", "_whole")
    around = containing(near, asked.withColumnsRenamed({"_name": "_whole"}), "_name", "_whole")
    matched = (
        inside.select("_place", "_len", "file_order").unionByName(around.select("_place", "_len", "file_order")).groupBy("_place").agg(F.min_by("_len", "file_order").alias(length))
    )
    known = places.join(exact, F.col("_place") == F.col("_loc")).select(
        "_place", F.col("_exact").alias(length)
    )
    lengths = known.unionByName(matched)
    return join_small(laps, lengths, F.col(location) == F.col("_place")).drop("_place")


#: Characters of the longest gram of the index.
GRAM = 3


def grams(name: str, size: Column | int) -> Column:
    """The distinct runs of ``size`` characters of a name; the empty one for a size of 0."""
    size = F.lit(size) if isinstance(size, int) else size
    starts = F.when(F.length(name) >= size, F.sequence(F.lit(1), F.length(name) - size + 1))
    cut = F.array_distinct(F.transform(starts, lambda i: F.substring(F.col(name), i, size)))
    return F.when(size == 0, F.array(F.lit(""))).otherwise(F.coalesce(cut, F.array().cast("array<string>")))


def containing(parts: DataFrame, wholes: DataFrame, part: str, whole: str) -> DataFrame:
    """Every pair of a row of ``parts`` and a row of ``wholes`` whose name contains the part's, with the columns of both.

    An inverted index of the wholes' runs of up to ``GRAM`` characters: a part, whatever its length, is looked up by the
    rarest of its own runs, and what is found there is verified. The index grows with the length of the names, not with
    its square; it is made twice, so ``wholes`` should be a table that is quick to read.
    """
    index = wholes.where(F.col(whole).isNotNull()).withColumn("_gram", F.explode(F.flatten(F.array(*[grams(whole, n) for n in range(GRAM + 1)]))))
    often = index.groupBy("_gram").agg(F.count("*").alias("_often"))
    asked = parts.where(F.col(part).isNotNull()).select(F.col(part).alias("_part")).distinct()
    own = asked.withColumn("_gram", F.explode(grams("_part", F.least(F.length("_part"), F.lit(GRAM)))))
    # a run that no whole has rules the part out, so it counts as the rarest
    rarest = own.join(often, "_gram", "left").groupBy("_part").agg(F.min(F.struct(F.coalesce("_often", F.lit(0)).alias("n"), "_gram")).alias("_r"))
    looked = rarest.where("_r.n > 0").select("_part", F.col("_r._gram").alias("_gram"))
    met = looked.join(index, "_gram").where(F.contains(F.col(whole), F.col("_part"))).drop("_gram")
    return parts.join(met, parts[part] == met["_part"]).drop("_part")
