"""Class-weighted baseline for the next-lap tyre change, and scoring with what was saved."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.functions.joins import join_small
from stintlake.functions.ordered import OrderedGroups
from stintlake.operators.mldata import CAR_ID, class_weights, label_encode
from stintlake.plans.ml_stages import CategoryCodes, CategoryCodesModel, RobustScaler, WindowFeatures
from stintlake.session import stage

TARGET = "tire_change_next_lap"


def window_features(df: DataFrame, columns: list[str], length: int = 10) -> tuple[DataFrame, list[str]]:
    """The last lap's values and their mean and change over the ``length`` laps up to it."""
    exprs = {}
    for c in columns:
        value = F.col(c).cast("double")
        exprs[f"{c}_last"] = lambda w, v=value: v
        exprs[f"{c}_mean"] = lambda w, v=value: F.avg(v).over(w.rowsBetween(1 - length, 0))
        exprs[f"{c}_change"] = lambda w, v=value: v - F.first(v).over(w.rowsBetween(1 - length, 0))
    g = OrderedGroups(df, CAR_ID, ["LapNumber"]).frames(exprs, before=length - 1)
    return g.result(), list(exprs)


def train_change(train: DataFrame, names: list[str], iterations: int = 20) -> PipelineModel:
    """Logistic regression of the change, rows weighted against the class imbalance."""
    filled = [f"{n}_filled" for n in names]
    params = dict(labelCol=TARGET, weightCol="weight", probabilityCol="_p", predictionCol="_said", maxIter=iterations)
    stages = [
        Imputer(strategy="mean", inputCols=names, outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="_features"),
        LogisticRegression(featuresCol="_features", rawPredictionCol="_raw", **params),
    ]
    return Pipeline(stages=stages).fit(_weighted(train))


def _weighted(train: DataFrame) -> DataFrame:
    weights = class_weights(train, TARGET).select(F.col("class").alias(TARGET), "weight")
    return join_small(train, weights, [TARGET], "inner")


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows with the probability ``prob`` of a change on the next lap."""
    scored = model.transform(rows)
    keep = [c for c in rows.columns if c in scored.columns]
    return scored.select(*keep, vector_to_array("_p")[1].alias("prob"))


def score_session(
    path: str, rows: DataFrame, driver: str | None = None, year: int | None = None, location: str | None = None
) -> DataFrame:
    """Score the laps of one driver, season or circuit with a saved model."""
    model = PipelineModel.load(path)
    for column, value in (("Driver", driver), ("Year", year), ("Location", location)):
        if value is not None:
            rows = rows.where(F.col(column) == value)
    return score(model, rows)


# -- two heads on the same features ------------------------------------------


def train_heads(
    train: DataFrame, columns: list[str], length: int = 10, iterations: int = 200, ridge: float = 0.01, tolerance: float = 1e-10
) -> PipelineModel:
    """Window features, codes and scaling, then a head for the change and one for the next compound, as one pipeline.

    The change head weighs the classes alike; the compound head learns from the laps with a change. The ridge leaves the
    intercepts free, so that on the training rows the mean probabilities are the shares of the classes.
    """
    windows = WindowFeatures(columns, length)
    codes = CategoryCodes(["Compound"])
    shaped = [
        codes,
        RobustScaler(windows.made()),
        OneHotEncoder(inputCols=["Compound_index"], outputCols=["_compound"], handleInvalid="keep"),
        VectorAssembler(inputCols=[*windows.made(), "_compound"], outputCol="_features"),
    ]
    # fitting codes, quartiles and widths reads the windows several times; they run once, over the columns that are asked for
    needed = train.select(*dict.fromkeys([*CAR_ID, "LapNumber", *columns, "Compound", "next_tire_type", TARGET]))
    seen = stage(windows.transform(needed), "windows")
    features = Pipeline(stages=shaped).fit(seen)
    fitted = next(s for s in features.stages if isinstance(s, CategoryCodesModel))
    rows = label_encode(features.transform(seen), "next_tire_type", fitted.codes("Compound"), "_type")
    rows = stage(rows.select(TARGET, "_type", "_features"), "features")
    common = dict(featuresCol="_features", maxIter=iterations, tol=tolerance, regParam=ridge)
    change = LogisticRegression(labelCol=TARGET, weightCol="weight", probabilityCol="_p", rawPredictionCol="_raw", predictionCol="_said", **common)
    kind = LogisticRegression(labelCol="_type", family="multinomial", probabilityCol="_tp", rawPredictionCol="_traw", predictionCol="type_pred", **common)
    changed = rows.where((F.col(TARGET) == 1) & F.col("_type").isNotNull())
    return PipelineModel([windows, *features.stages, change.fit(_weighted(rows)), kind.fit(changed)])


def compounds(model: PipelineModel) -> DataFrame:
    """``value, code`` of the compounds that ``type_pred`` and ``type_probs`` number."""
    return next(s for s in model.stages if isinstance(s, CategoryCodesModel)).codes("Compound")


def score_heads(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Raw lap rows with ``prob`` of a change, ``type_pred``, the code of the likeliest next compound, and ``type_probs``."""
    scored = model.transform(rows)
    return scored.select(
        *rows.columns,
        vector_to_array("_p")[1].alias("prob"),
        F.col("type_pred").cast("int").alias("type_pred"),
        vector_to_array("_tp").alias("type_probs"),
    )


def score_requests(model: PipelineModel, laps: DataFrame, requests: DataFrame) -> DataFrame:
    """Scores of the laps that many requests ask for: ``request_id, Year`` and, null for any, ``Driver`` and ``Location``.

    ``laps`` is partitioned by ``Year``. Spark reads the seasons that the requests name, which it finds out as the query
    runs. A car's whole race goes through the windows once, however many requests ask for it.
    """
    asked = requests.select("request_id", F.col("Year").alias("_year"), F.col("Driver").alias("_driver"), F.col("Location").alias("_place"))
    asked = asked.where("_year > 0")
    this = (
        (F.col("Year") == F.col("_year"))
        & (F.col("_driver").isNull() | (F.col("Driver") == F.col("_driver")))
        & (F.col("_place").isNull() | (F.col("Location") == F.col("_place")))
    )
    wanted = laps.join(asked, this, "left_semi")
    scored = score_heads(model, wanted)
    return scored.join(asked, this).select("request_id", "GlobalLapID", "Driver", "Location", "Year", "LapNumber", "prob", "type_pred", "type_probs")
