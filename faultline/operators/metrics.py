"""Classifier metrics, curves and calibration measures from counts per distinct score."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from faultline.operators.ordered import cumulative


def score_counts(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score: positives and negatives at it, below it and in total."""
    y = F.col(label)
    rows = df.filter(y.isNotNull())
    return cumulative(rows, score, {"pos": F.count_if(y == 1), "neg": F.count_if(y == 0)}, by=by)


def _above(m: str) -> Column:
    """Count at or above the score."""
    return F.col(f"{m}_total") - F.col(f"{m}_before")


def ranking_metrics(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC (ties count one half) and average precision (step rule over distinct thresholds)."""
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    tp, fp = _above("pos"), _above("neg")
    wins = F.sum(pos * (F.col("neg_before") + neg / 2.0))
    steps = F.sum(F.try_divide(pos, F.col("pos_total")) * (tp / (tp + fp)))
    total = F.max(F.col("pos_total").cast("double") * F.col("neg_total"))
    counts = score_counts(df, label, score, by)
    grouped = counts.groupBy(*by) if by else counts
    return grouped.agg(F.try_divide(wins, total).alias("auc"), steps.alias("average_precision"))


def threshold_metrics(df: DataFrame, label: str, score: str, threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 of ``score >= threshold``; 0 where undefined."""
    y, hit = F.col(label), F.col(score) >= threshold
    grouped = df.groupBy(*by) if by else df
    counts = grouped.agg(
        F.count_if(hit & (y == 1)).alias("tp"), F.count_if(hit & (y == 0)).alias("fp"),
        F.count_if(~hit & (y == 1)).alias("fn"), F.count_if(~hit & (y == 0)).alias("tn"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns({
        "precision": F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)),
        "recall": F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)),
        "f1": F.coalesce(F.try_divide(tp * 2, tp * 2 + fp + fn), F.lit(0.0))})


def binary_metrics(df: DataFrame, label: str, score: str, threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """All five measures of a scored table, one row per group."""
    by = list(by)
    ranks = ranking_metrics(df, label, score, by)
    cuts = threshold_metrics(df, label, score, threshold, by).drop("tp", "fp", "fn", "tn")
    if by:
        return ranks.join(cuts, by)
    one = cuts.select(F.struct("precision", "recall", "f1").alias("c")).scalar()
    return ranks.withColumn("_c", one).select("auc", "average_precision", "_c.*")


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    c = score_counts(df, label, score)
    points = c.select(F.col(score).alias("threshold"), F.try_divide(_above("neg"), F.col("neg_total")).alias("fpr"),
                      F.try_divide(_above("pos"), F.col("pos_total")).alias("tpr"))
    origin = df.limit(1).select(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(origin)


def pr_points(df: DataFrame, label: str, score: str) -> DataFrame:
    c = score_counts(df, label, score)
    points = c.select(F.col(score).alias("threshold"),
                      (_above("pos") / (_above("pos") + _above("neg"))).alias("precision"),
                      F.try_divide(_above("pos"), F.col("pos_total")).alias("recall"))
    end = df.limit(1).select(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return points.unionByName(end)


def confusion(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    return df.groupBy(F.col(label).cast("int").alias("actual"), (F.col(score) >= threshold).cast("int").alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def reliability(df: DataFrame, label: str, score: str, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Mean score and positive share per equal-width bin; an inner edge belongs to the lower bin."""
    edges = np.linspace(0.0, 1.0, bins + 1)[1:-1]
    index = sum(((F.col(score) > float(e)).cast("int") for e in edges), F.lit(0))
    return df.groupBy(*by, index.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_predicted"), F.avg(label).alias("positive_share"))


def calibration_error(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Unweighted mean gap over the bins that hold rows."""
    gap = F.avg(F.abs(F.col("positive_share") - F.col("mean_predicted"))).alias("calibration_error")
    return curve.groupBy(*by).agg(gap) if by else curve.agg(gap)


def brier(label: str, score: str) -> Column:
    return F.avg((F.col(score) - F.col(label)) * (F.col(score) - F.col(label)))


def log_loss(label: str, score: str, eps: float = 2.220446049250313e-16) -> Column:
    p = F.greatest(F.least(F.col(score), F.lit(1.0 - eps)), F.lit(eps))
    loss = -F.when(F.col(label) == 1, F.log(p)).when(F.col(label) == 0, F.log1p(-p))
    return F.avg(F.when(F.col(score).isNotNull(), loss))


def calibration_metrics(long: DataFrame, label: str, score: str, by: Sequence[str], bins: int = 10) -> DataFrame:
    """Brier score, log loss and calibration error per group (model, horizon)."""
    by = list(by)
    losses = long.groupBy(*by).agg(brier(label, score).alias("brier"), log_loss(label, score).alias("log_loss"))
    return losses.join(calibration_error(reliability(long, label, score, bins, by), by), by)


def calibration_improvement(metrics: DataFrame, horizon: str = "horizon", model: str = "model",
                            base: str = "Uncalibrated", others: Sequence[str] = ("Isotonic", "Platt")) -> DataFrame:
    """One row per horizon: the calibration error of every model and the improvement over the base in percent."""
    wide = metrics.groupBy(horizon).pivot(model, [base, *others]).agg(F.first("calibration_error"))
    before = F.col(base)
    return wide.select(horizon, *[F.col(m).alias(f"{m.lower()}_error") for m in (base, *others)],
                       *[(F.try_divide(before - F.col(m), before) * 100.0).alias(f"{m.lower()}_improvement") for m in others])


def compare_models(metric_rows: Sequence[DataFrame]) -> DataFrame:
    """Metric rows of several models, the best AUC of each horizon marked."""
    from faultline.operators.sets import union_all

    rows = union_all(metric_rows)
    best = rows.groupBy("horizon").agg(F.max_by("model", F.struct("auc", "model")).alias("best_model"))
    return rows.join(best, "horizon").withColumn("is_best", F.col("model") == F.col("best_model")).drop("best_model")
