"""Contributions of features to a score: the change when a feature is set to its typical value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from faultline.operators.profile import rank_rows


def baseline(rows: DataFrame, features: Sequence[str]) -> list[float]:
    """Median of every feature (one number per column)."""
    from faultline.operators.ordered import quantiles

    found = {r["column"]: r["m"] for r in quantiles(rows, features, {"m": 0.5}).collect()}
    return [float(found.get(f) or 0.0) for f in features]


def contributions(model, rows: DataFrame, entity: str, features: Sequence[str], base: Sequence[float]) -> DataFrame:
    """(entity, feature, value, contribution): score minus the score with the feature at its baseline.

    Rows are scored once as they are, then spread over (row, feature) within their partition, without a shuffle.
    """
    names = F.array(*[F.lit(f) for f in features])
    typical = F.array(*[F.lit(float(b)) for b in base])
    whole = model.transform(rows.select(entity, "features")).select(
        entity, vector_to_array("features").alias("_x"), vector_to_array("probability")[1].alias("score"))
    spread = whole.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(features) - 1))).alias("_j"))
    replaced = F.transform("_x", lambda v, i: F.when(i == F.col("_j"), F.element_at(typical, i + 1)).otherwise(v))
    scored = model.transform(spread.withColumn("features", array_to_vector(replaced)))
    return scored.select(
        entity, F.element_at(names, F.col("_j") + 1).alias("feature"), F.element_at("_x", F.col("_j") + 1).alias("value"),
        (F.col("score") - vector_to_array("probability")[1]).alias("contribution"), "score")


def explain(contribution_rows: DataFrame, entity: str, k: int = 5) -> DataFrame:
    """Per asset: score, level, the k strongest features and a text. A row holds one entry per feature."""
    c = F.col("contribution") * 100
    arrow = F.when(c > 0, F.lit("↑")).otherwise(F.lit("↓"))
    text = F.concat(arrow, F.format_string(" %s=%.2f (%+.1f pts)", F.col("feature"), F.col("value"), c))
    entry = F.struct((-F.abs(c)).alias("o"), F.col("feature").alias("f"), text.alias("t"), c.alias("c"))
    grouped = contribution_rows.groupBy(entity).agg(
        F.first("score").alias("_s"), F.slice(F.sort_array(F.collect_list(entry)), 1, k).alias("_top"))
    score = F.round(F.col("_s") * 100, 2)
    return grouped.select(
        entity, score.alias("risk_score"), F.when(score >= 75, F.lit("Critical")).otherwise(F.lit("High")).alias("risk_level"),
        F.col("_top")[0]["f"].alias("top_factor"), F.round(F.col("_top")[0]["c"], 1).alias("top_contribution"),
        F.array_join(F.transform("_top", lambda e: e["t"]), " | ").alias("explanation"))


def explain_top_assets(model, rows: DataFrame, entity: str, features: Sequence[str], n: int = 100, k: int = 5) -> DataFrame:
    """Explanations of the n highest scores."""
    base = baseline(rows, features)
    scored = model.transform(rows).select(entity, "features", vector_to_array("probability")[1].alias("_p"))
    top = scored.orderBy(F.col("_p").desc(), entity).limit(n).select(entity, "features")
    return explain(contributions(model, top, entity, features, base), entity, k)


def global_importance(models: Mapping[str, tuple[DataFrame, object]], entity: str, features: Sequence[str]) -> DataFrame:
    """Mean absolute contribution per feature, averaged over the horizons, with rank and direction.

    ``models`` gives the prepared table and the model of every horizon.
    """
    out = None
    for h, (rows, model) in models.items():
        base = baseline(rows, features)
        one = contributions(model, rows, entity, features, base).groupBy("feature").agg(
            F.avg(F.abs("contribution")).alias("mean_abs"), F.avg("contribution").alias("mean_signed"))
        one = one.withColumn("horizon", F.lit(h))
        out = one if out is None else out.unionByName(one)
    averaged = out.groupBy("feature").agg(F.avg("mean_abs").alias("importance"), F.avg("mean_signed").alias("_d"))
    return rank_rows(averaged.select("feature", "importance", F.when(F.col("_d") > 0, F.lit("increases")).otherwise(
        F.lit("decreases")).alias("direction")), [F.col("importance").desc(), "feature"])
