"""Consequence of failure, risk per horizon, priorities and the investment list."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from faultline import config
from faultline.functions import scalars as S
from faultline.operators.clean import valid_duration
from faultline.operators.ordered import quantile_value, with_ranks
from faultline.session import checkpoint


def average_outage(assets: DataFrame, events: DataFrame, entity: str, minutes: str,
                   longest: float = config.MAX_OUTAGE_MINUTES,
                   default: float = config.DEFAULT_OUTAGE_MINUTES) -> DataFrame:
    """Mean plausible outage per asset; without one the median of the asset means, else the default."""
    means = checkpoint(valid_duration(events, minutes, longest).groupBy(entity).agg(F.avg(minutes).alias("_mean")))
    typical = quantile_value(means, "_mean", 0.5)
    return assets.join(means, entity, "left").withColumn(
        "avg_outage_minutes", F.coalesce(F.col("_mean"), typical, F.lit(default))).drop("_mean")


def affected_customers(assets: DataFrame, columns: Sequence[str], default: float = config.DEFAULT_CUSTOMERS) -> DataFrame:
    value = S.row_sum(columns) if columns else F.lit(default)
    return assets.withColumn("customers_affected", value)


def consequence(assets: DataFrame, minutes: str = "avg_outage_minutes", customers: str = "customers_affected",
                multiplier: Column | None = None) -> DataFrame:
    """Raw consequence, its percentile score (0 to 100) and category."""
    raw = F.col(minutes) * F.col(customers) * (F.lit(1.0) if multiplier is None else multiplier)
    # Ranking reads its input more than once, so the per-asset rows are written once before it.
    scored = with_ranks(checkpoint(assets.withColumn("cof_raw", raw)), "cof_raw", pct="cof_score")
    return scored.withColumn("cof_category", S.cut("cof_score", *config.RISK_BINS, include_lowest=True))


def customer_multiplier(column: str, multipliers: Mapping[str, float]) -> Column:
    """Optional weight by customer kind; 1 where the kind is not listed."""
    return F.coalesce(S.lookup(column, multipliers), F.lit(1.0))


def cof_cutoffs(scored: DataFrame, score: str = "cof_score") -> DataFrame:
    from faultline.operators.ordered import quantiles

    return quantiles(scored, [score], {"p75": 0.75, "p90": 0.90, "p95": 0.95}).drop("column")


def join_risk(pof: DataFrame, cof: DataFrame, entity: str) -> DataFrame:
    return pof.join(cof, entity, "left")


def risk(base: DataFrame, pof: str, by: Sequence[str] = ()) -> DataFrame:
    """Risk = probability x consequence with percentile score, category and priority rank.

    With ``by`` (the horizon column of a long table) all horizons are ranked in one pass.
    """
    raw = checkpoint(base.withColumn("risk_raw", F.col(pof) * F.col("cof_raw")))
    ranked = with_ranks(raw, "risk_raw", pct="risk_score", priority="priority_rank", by=by)
    return ranked.withColumn("risk_category", S.cut("risk_score", *config.RISK_BINS, include_lowest=True))


def long_probabilities(wide: DataFrame, entity: str, columns: Mapping[str, str]) -> DataFrame:
    """(asset, horizon, probability) rows from one column per horizon."""
    pairs = [F.struct(F.lit(h).alias("horizon"), F.col(c).alias("pof")) for h, c in columns.items()]
    return wide.select(entity, F.inline(F.array(*pairs)))


def capex(ranked: DataFrame, entity: str, k: int = 100) -> DataFrame:
    """The k highest priorities with the recommended action."""
    top = ranked.orderBy(F.col("priority_rank").asc_nulls_last(), entity).limit(k)
    return top.withColumn("recommended_action", S.recommended_action("risk_category"))


def action_counts(capex_rows: DataFrame) -> DataFrame:
    return capex_rows.groupBy("recommended_action").agg(F.count(F.lit(1)).alias("n"))


def priority_candidates(ranked: DataFrame, categories: Sequence[str] = ("YÜKSEK", "KRİTİK")) -> DataFrame:
    return ranked.filter(F.col("risk_category").isin(*categories))
