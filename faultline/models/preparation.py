"""Preparing features as pipeline stages, so that what is learnt from rows comes from the training share and is saved with the model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from faultline.functions import scalars as S
from faultline.operators.ordered import quantiles


class _Columns(Params):
    numbers = Param(Params._dummy(), "numbers", "numeric columns", TypeConverters.toListString)
    texts = Param(Params._dummy(), "texts", "text columns", TypeConverters.toListString)
    medians = Param(Params._dummy(), "medians", "median of every numeric column", TypeConverters.toListFloat)


class Fill(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the exact median of every numeric column; a column without finite values has 0."""

    @keyword_only
    def __init__(self, numbers=None, texts=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> FillModel:
        numbers = self.getOrDefault(self.numbers)
        found = {}
        if numbers:
            cleaned = dataset.select(*[S.finite(c).alias(c) for c in numbers])
            found = {r["column"]: r["m"] for r in quantiles(cleaned, numbers, {"m": 0.5}).collect()}  # one row per column
        return FillModel(numbers=numbers, texts=self.getOrDefault(self.texts), medians=[float(found.get(c) or 0.0) for c in numbers])


class FillModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Fills missing and non-finite numbers with the learnt medians and missing text with the text 'nan' (in ``<column>_text``)."""

    @keyword_only
    def __init__(self, numbers=None, texts=None, medians=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        numbers = zip(self.getOrDefault(self.numbers), self.getOrDefault(self.medians))
        filled = {c: F.coalesce(S.finite(c), F.lit(m)) for c, m in numbers}
        return dataset.withColumns(filled | {f"{c}_text": S.null_text(c) for c in self.getOrDefault(self.texts)})


def fit_preparation(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = ()) -> PipelineModel:
    """Medians and label codes of the training rows, and the vector of both.

    Labels are coded alphabetically; one that was not seen gets a code of its own. The vector declares text columns as
    categories and all others as numbers, whatever the number of their values.
    """
    numeric, categorical = list(numeric), list(categorical)
    stages = [Fill(numbers=numeric, texts=categorical)]
    if categorical:
        stages.append(StringIndexer(inputCols=[f"{c}_text" for c in categorical], outputCols=[f"{c}_code" for c in categorical],
                                    stringOrderType="alphabetAsc", handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=feature_names(numeric, categorical), outputCol="features", handleInvalid="keep"))
    return Pipeline(stages=stages).fit(train)


def feature_names(numeric: Sequence[str], categorical: Sequence[str] = ()) -> list[str]:
    """The names in the order of the vector."""
    return [*numeric, *[f"{c}_code" for c in categorical]]


def widest_category(rows: DataFrame, features: str = "features") -> int:
    """The number of codes of the widest declared category of a vector column; 0 without any."""
    nominal = rows.schema[features].metadata.get("ml_attr", {}).get("attrs", {}).get("nominal", [])
    return max((len(a["vals"]) for a in nominal), default=0)
