"""Isotonic and Platt calibration of fitted scores on a held-out fold."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, functions as F

from faultline import config
from faultline.functions import scalars as S


def _counted(df: DataFrame, label: str, score: str, digits: int) -> DataFrame:
    """One weighted row per score on a fixed grid, so the fit sees at most 10^digits + 1 rows."""
    return df.groupBy(F.round(score, digits).alias("score")).agg(
        F.avg(F.col(label).cast("double")).alias("label"), F.count(F.lit(1)).cast("double").alias("weight"))


def calibrate_isotonic(held_out: DataFrame, label: str, score: str, digits: int = 6):
    """Monotone step fit of bounded size.

    Scores are rounded to ``digits`` decimals and averaged per rounded score, so at most 10^digits + 1 rows are
    fitted. Rows of one score don't change the fit by that; scores closer than the grid share a step.
    """
    rows = _counted(held_out, label, score, digits)
    return IsotonicRegression(featuresCol="score", labelCol="label", weightCol="weight").fit(rows)


def apply_isotonic(model, df: DataFrame, score: str, out: str) -> DataFrame:
    p = model.transform(df.withColumn("score", F.col(score))).withColumnRenamed("prediction", out)
    p = p if score == "score" else p.drop("score")
    return p.withColumn(out, F.greatest(F.least(F.col(out), F.lit(1.0)), F.lit(0.0)))


def _vector(df: DataFrame, score: str) -> DataFrame:
    eps = 1e-12
    p = F.greatest(F.least(F.col(score), F.lit(1 - eps)), F.lit(eps))
    return VectorAssembler(inputCols=["_logit"], outputCol="_v").transform(df.withColumn("_logit", F.log(p / (1 - p))))


def calibrate_platt(held_out: DataFrame, label: str, score: str):
    """Sigmoid on the log-odds of the score, with Platt's smoothed targets as row weights."""
    counts = held_out.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n"))
    rows = _vector(held_out.withColumn("_c", counts.select(F.struct("p", "n")).scalar()), score)
    hi, lo = (F.col("_c.p") + 1) / (F.col("_c.p") + 2), F.lit(1.0) / (F.col("_c.n") + 2)
    target = F.when(F.col(label) == 1, hi).otherwise(lo)
    both = rows.select("_v", F.inline(F.array(F.struct(F.lit(1.0).alias("y"), target.alias("w")),
                                              F.struct(F.lit(0.0).alias("y"), (1 - target).alias("w")))))
    return LogisticRegression(featuresCol="_v", labelCol="y", weightCol="w", regParam=0.0).fit(both)


def apply_platt(model, df: DataFrame, score: str, out: str) -> DataFrame:
    scored = model.transform(_vector(df, score)).withColumn(out, vector_to_array("probability")[1])
    return scored.select(*df.columns, out)


def score_calibrated(model, scored: DataFrame, entity: str, score: str, carry=()) -> DataFrame:
    """Calibrated probability, score and level of every asset, highest first."""
    p = apply_isotonic(model, scored, score, "calibrated_probability")
    out = p.select(entity, *carry, "calibrated_probability", S.risk_score("calibrated_probability").alias("risk_score"))
    return out.withColumn("risk_level", S.cut("risk_score", *config.SCORE_BINS)).orderBy(F.col("risk_score").desc(), entity)
