"""From the race table to features, splits and sequences."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.functions.ordered import looked_at
from stintlake.operators import features as X
from stintlake.operators import laps as L
from stintlake.operators import mldata as M
from stintlake.operators import quality as Q
from stintlake.session import stage

CATEGORIES = ["Compound", "Team", "Location", "Driver"]


def dataset(race_laps: DataFrame) -> DataFrame:
    """Clean laps with identifiers, exact duplicates dropped."""
    return L.with_ids(Q.dedupe_exact(L.clean(race_laps)))


def features(df: DataFrame) -> DataFrame:
    """Targets and all engineered columns, missing values filled.

    The car-level steps share one exchange. The result of each group of steps
    is staged before the next one looks at it again, so that no step repeats
    the work of the ones before.
    """
    car = X.rolling_trends(X.targets(X.by_car(df)))
    rows = X.degradation_rate(car).result()
    rows = X.domain_features(L.weather_flags(L.log_deltas(L.position_features(rows))))
    rows = stage(rows, "car-features")
    with looked_at(rows, X.RACE_ID, X.CAR_ID):
        rows = X.stint_progress(X.lap_progress(rows))
        rows = X.compound_strategy(X.compound_age_ratio(rows))
        rows = stage(X.weather_stability(rows), "race-features")
        return fill(rows)


def fill(df: DataFrame) -> DataFrame:
    """Forward fill by car, interpolation by race, medians, zeros."""
    rows = X.forward_fill(X.by_car(df)).result()
    rows = stage(X.interpolate(X.by_race(rows)).result(), "filled")
    return X.fill_zero(X.fill_median(rows))


@dataclass
class Prepared:
    """Encoded and scaled rows of all splits with what was fitted on the training rows."""

    rows: DataFrame
    codes: dict[str, DataFrame]
    scaling: DataFrame
    scaled: list[str]
    features: list[str]

    def sequences(self, length: int = 10) -> DataFrame:
        type_codes = self.codes["Compound"]
        rows = M.label_encode(self.rows, "next_tire_type", type_codes, "_type")
        return M.sequences(rows, self.features, length, "_type")


def prepare(feature_rows: DataFrame) -> Prepared:
    """Split by season, then encode and scale with codes and quartiles of the training rows."""
    split = stage(M.split_years(feature_rows), "splits")
    train = split.where(F.col("split") == "train")
    codes = {c: M.label_codes(train, c) for c in CATEGORIES}
    rows = split
    for c, table in codes.items():
        rows = M.label_encode(rows, c, table)
    rows = M.frequency_encode(rows)
    encoded_train = rows.where(F.col("split") == "train")
    scaled = M.scaled_columns(rows)
    scaling = M.robust_fit(encoded_train, scaled)
    done = M.robust_scale(rows, scaled, scaling)
    names = [
        f.name
        for f in done.schema.fields
        if f.name in M.feature_columns(done) and f.dataType.typeName() not in ("string",)
    ]
    return Prepared(done, codes, scaling, scaled, [n for n in names if n != "split"])
