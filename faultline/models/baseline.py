"""Linear baselines: logistic (L1/L2), ridge and lasso, chosen by AUC over a grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, functions as F

from faultline.models.training import tune, weighted

# Regularisation strengths tried.
STRENGTHS = (0.001, 0.01, 0.1, 1.0)


def fit_baseline(train: DataFrame, label: str, entity: str, kind: str, strengths: Sequence[float] = STRENGTHS):
    """``kind`` is logistic, ridge or lasso; the pipeline standardises first."""
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    if kind == "logistic":
        model = LogisticRegression(featuresCol="scaled", labelCol=label, weightCol="weight", maxIter=100)
        grid, raw = {model.regParam: strengths, model.elasticNetParam: (0.0, 1.0)}, "rawPrediction"
    else:
        model = LinearRegression(featuresCol="scaled", labelCol=label, elasticNetParam=1.0 if kind == "lasso" else 0.0)
        grid, raw = {model.regParam: strengths}, "prediction"
    pipeline = Pipeline(stages=[scaler, model])
    rows = weighted(train, label, balanced=True).withColumn(label, F.col(label).cast("double"))
    if len(strengths) == 1:
        model.setRegParam(strengths[0])
        return pipeline.fit(rows)
    return tune(pipeline, grid, rows, label, entity, raw=raw)


def baseline_scores(model, rows: DataFrame, out: str = "probability_1") -> DataFrame:
    """Probability, or the regression value clipped to [0, 1]."""
    scored = model.transform(rows)
    if "probability" in scored.columns:
        value = vector_to_array("probability")[1]
    else:
        value = F.greatest(F.least(F.col("prediction"), F.lit(1.0)), F.lit(0.0))
    return scored.select(*rows.columns, value.alias(out))


def coefficients(model, features: Sequence[str], spark) -> DataFrame:
    """Coefficient per standardised feature with absolute value and odds ratio, and the intercept."""
    last = model.stages[-1]
    rows = [(f, float(c)) for f, c in zip(features, last.coefficients.toArray())] + [("intercept", float(last.intercept))]
    df = spark.createDataFrame(rows, "feature string, coefficient double")
    return df.withColumns({"abs_coefficient": F.abs("coefficient"), "odds_ratio": F.exp("coefficient")})
