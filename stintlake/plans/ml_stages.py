"""Stages of a pipeline that can be saved: window features, codes of categories, robust scaling.

What is fitted is a table and is saved as one; the parameters are saved as those of any stage.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.functions.ordered import OrderedGroups
from stintlake.operators import mldata as M
from stintlake.session import stage

KINDS = ("last", "mean", "change")


class _Columns(Params):
    columns = Param(Params._dummy(), "columns", "columns the stage works on", TypeConverters.toListString)

    def __init__(self, columns: list[str] | None = None):
        super().__init__()
        if columns is not None:
            self._set(columns=list(columns))

    def names(self) -> list[str]:
        return self.getOrDefault(self.columns)


class WindowFeatures(_Columns, Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """For each column the last lap's value and its mean and change over the ``length`` laps of the car up to it."""

    length = Param(Params._dummy(), "length", "laps of a window", TypeConverters.toInt)

    def __init__(self, columns: list[str] | None = None, length: int = 10):
        super().__init__(columns)
        self._set(length=length)

    def made(self) -> list[str]:
        return [f"{c}_{kind}" for c in self.names() for kind in KINDS]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        length, exprs = self.getOrDefault(self.length), {}
        for c in self.names():
            value = F.col(c).cast("double")
            exprs[f"{c}_last"] = lambda w, v=value: v
            exprs[f"{c}_mean"] = lambda w, v=value: F.avg(v).over(w.rowsBetween(1 - length, 0))
            exprs[f"{c}_change"] = lambda w, v=value: v - F.first(v).over(w.rowsBetween(1 - length, 0))
        return OrderedGroups(dataset, M.CAR_ID, ["LapNumber"]).frames(exprs, before=length - 1).result()


class _Fitted(_Columns, Model, MLReadable, MLWritable):
    """A model that is a table."""

    def __init__(self, columns: list[str] | None = None, table: DataFrame | None = None):
        super().__init__(columns)
        self.table = table

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, stage: _Fitted):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        self.stage.table.write.parquet(os.path.join(path, "table"))


class _Reader(MLReader):
    def __init__(self, kind: type[_Fitted]):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> _Fitted:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        found = self.kind(table=self.sparkSession.read.parquet(os.path.join(path, "table")))
        found._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(found, metadata)
        return found


class CategoryCodes(_Columns, Estimator):
    """Codes of each column's values in string order, as ``<column>_encoded``; others get null there.

    ``<column>_index`` has the codes as numbers, and one past the last for other values.
    """

    def _fit(self, dataset: DataFrame) -> CategoryCodesModel:
        tables = [M.label_codes(dataset, c).select(F.lit(c).alias("column"), "value", "code") for c in self.names()]
        table = stage(reduce(DataFrame.unionByName, tables), "codes")
        sizes = dict(table.groupBy("column").count().collect())  # a number a column
        return CategoryCodesModel(self.names(), table)._set(sizes=[sizes[c] for c in self.names()])


class CategoryCodesModel(_Fitted):
    sizes = Param(Params._dummy(), "sizes", "how many codes each column has", TypeConverters.toListInt)

    def codes(self, column: str) -> DataFrame:
        return self.table.where(F.col("column") == column).select("value", "code")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        for c, size in zip(self.names(), self.getOrDefault(self.sizes)):
            dataset = M.label_encode(dataset, c, self.codes(c))
            dataset = dataset.withColumn(f"{c}_index", F.coalesce(F.col(f"{c}_encoded"), F.lit(size)).cast("double"))
        return dataset


class RobustScaler(_Columns, Estimator):
    """Columns centred on the median and divided by the spread of the quartiles; missing values become 0, the median."""

    def _fit(self, dataset: DataFrame) -> RobustScalerModel:
        return RobustScalerModel(self.names(), stage(M.robust_fit(dataset, self.names()), "quartiles"))


class RobustScalerModel(_Fitted):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        scaled = M.robust_scale(dataset, self.names(), self.table)
        return scaled.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in self.names()})
