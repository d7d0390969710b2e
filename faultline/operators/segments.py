"""Segment statistics: comparisons by class, region, season or flag, failure rates, crosstabs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from faultline.functions import scalars as S
from faultline.functions.dates import moment
from faultline.operators.ordered import quantiles


def segment_stats(df: DataFrame, keys: Sequence[str], metrics: Mapping[str, Column]) -> DataFrame:
    """The same metrics by each key separately, in one pass over the table (grouping sets)."""
    texts = [F.col(k).cast("string").alias(k) for k in keys]
    base = df.select(*texts, *[c for c in df.columns if c not in keys])
    aggs = [m.alias(name) for name, m in metrics.items()]
    sets = base.groupingSets([[F.col(k)] for k in keys], *[F.col(k) for k in keys]).agg(
        F.grouping_id(*[F.col(k) for k in keys]).alias("_gid"), *aggs)
    full = (1 << len(keys)) - 1
    name, value = None, None
    for i, k in enumerate(keys):
        here = F.col("_gid") == F.lit(full ^ (1 << (len(keys) - 1 - i)))
        name = F.when(here, F.lit(k)) if name is None else name.when(here, F.lit(k))
        value = F.when(here, F.col(k)) if value is None else value.when(here, F.col(k))
    return sets.select(name.alias("segment"), value.alias("value"), *metrics)


def failure_rates(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Per horizon: assets with and without failures, share with, mean, maximum and exact median count."""
    pairs = [F.struct(F.lit(h).alias("column"), F.col(c).cast("double").alias("v")) for h, c in columns.items()]
    long = df.select(F.inline(F.array(*pairs)))
    stats = long.groupBy("column").agg(
        F.count_if(F.col("v") > 0).alias("with_failures"), F.count_if(F.col("v") == 0).alias("without_failures"),
        (F.count_if(F.col("v") > 0) / F.count(F.lit(1)) * 100.0).alias("failure_rate"),
        F.avg("v").alias("mean"), F.max("v").alias("max"))
    renamed = df.select(*[F.col(c).alias(h) for h, c in columns.items()])
    medians = quantiles(renamed, list(columns), {"median": 0.5})
    return stats.join(medians, "column").withColumnRenamed("column", "horizon")


def compare_groups(df: DataFrame, flag: str, value: str) -> DataFrame:
    """Mean of a value where a 0/1 flag is set and where it is not, their ratio and difference."""
    on, off = F.avg(F.when(F.col(flag) == 1, F.col(value))), F.avg(F.when(F.col(flag) == 0, F.col(value)))
    return df.agg(on.alias("flagged_mean"), off.alias("other_mean")).withColumns({
        "ratio": F.when(F.col("other_mean") > 0, F.col("flagged_mean") / F.col("other_mean")),
        "difference": F.col("other_mean") - F.col("flagged_mean")})


def _top_list(df: DataFrame, column: str, k: int) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n")).orderBy(
        F.col("_n").desc(), column).limit(k).select(column)


def crosstab_pct(df: DataFrame, a: str, b: str, top_a: int, top_b: int) -> DataFrame:
    """Counts of (a, b) among the most frequent values of both, with the share in the row total."""
    counts = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    kept = counts.join(F.broadcast(_top_list(df, a, top_a)), a, "left_semi").join(
        F.broadcast(_top_list(df, b, top_b)), b, "left_semi")
    return kept.withColumn("row_pct", F.col("n") / F.sum("n").over(Window.partitionBy(a)) * 100.0)


def crosstab_wide(crosstab: DataFrame, a: str, b: str, values: Sequence[str]) -> DataFrame:
    return crosstab.groupBy(a).pivot(b, list(values)).agg(F.sum("n")).fillna(0)


def rate_by_class(df: DataFrame, asset_class: str, target: str, rare: int = 20) -> DataFrame:
    rate = F.avg(target) * 100.0
    return df.filter(F.col(asset_class).isNotNull()).groupBy(asset_class).agg(
        F.count(target).alias("n"), F.sum(target).alias("failures"), rate.alias("failure_rate")).withColumns({
            "zero_failures": F.col("failures") == 0, "high_rate": F.col("failure_rate") > 30,
            "rare": F.col("n") < rare})


def samples_needed(df: DataFrame, target: str, ratio: float = 0.33) -> DataFrame:
    """How many synthetic positives bring the positive share to ``ratio``; none below six positives."""
    pos, neg = F.sum(F.col(target).cast("bigint")), F.count_if(F.col(target) == 0)
    needed = F.floor(F.col("negatives") * ratio / (1 - ratio))
    return df.agg(pos.alias("positives"), neg.alias("negatives")).withColumn(
        "synthetic_needed", F.when(F.col("positives") >= 6, needed - F.col("positives")))


def target_distribution(df: DataFrame, targets: Sequence[str], healthy: str) -> DataFrame:
    """Assets and positives per target, by healthy flag, with the positive rate."""
    pairs = [F.struct(F.lit(t).alias("target"), F.col(t).cast("bigint").alias("y")) for t in targets]
    return df.select(F.col(healthy).alias("healthy"), F.inline(F.array(*pairs))).groupBy("target", "healthy").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("positives"), (F.avg("y") * 100.0).alias("positive_rate"))


def group_classes(df: DataFrame, column: str, rules, min_n: int, out: str, text: str | None = None,
                  other: str = "Other_Equipment") -> DataFrame:
    """Keyword groups of a class; a class without keyword keeps its name when frequent, else is ``other``."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    joined = df.join(counts, column, "left")
    own = F.when(F.col("_n") >= min_n, F.col(column)).otherwise(F.lit(other))
    return joined.withColumn(out, F.coalesce(S.class_group(text or column, rules), own)).drop("_n")


def window_availability(df: DataFrame, ts: str, entity: str, cutoff: str, months: Sequence[int]) -> DataFrame:
    """Events and distinct assets in every window (cutoff, cutoff + m months]; the distinct count takes one row
    per (asset, earliest window) first."""
    start = moment(cutoff).cast("timestamp_ntz")
    limits = sorted(months)
    first = F.lit(None).cast("int")
    for m in reversed(limits):
        first = F.when(F.col(ts) <= start + F.make_interval(months=F.lit(m)), F.lit(m)).otherwise(first)
    rows = df.filter(F.col(ts) > moment(cutoff)).select(entity, first.alias("_w")).filter(F.col("_w").isNotNull())
    per = rows.groupBy(entity, "_w").agg(F.count(F.lit(1)).alias("_n"))
    pairs = [F.struct(F.lit(m).alias("months")) for m in limits]
    spread = per.select(entity, "_w", "_n", F.inline(F.array(*pairs))).filter(F.col("_w") <= F.col("months"))
    by_asset = spread.groupBy("months", entity).agg(F.sum("_n").alias("_n"))
    return by_asset.groupBy("months").agg(F.sum("_n").alias("n_events"), F.count(entity).alias("n_assets"))


def events_per_feature(df: DataFrame, targets: Sequence[str], n_features: int) -> DataFrame:
    pairs = [F.struct(F.lit(t).alias("target"), F.col(t).cast("bigint").alias("y")) for t in targets]
    ratio = F.col("positives") / F.lit(n_features)
    return df.select(F.inline(F.array(*pairs))).groupBy("target").agg(F.sum("y").alias("positives")).withColumn(
        "ratio", ratio).withColumn("band", F.when(F.col("ratio") < 5, F.lit("severe")).when(
            F.col("ratio") < 10, F.lit("high")).when(F.col("ratio") < 20, F.lit("moderate")).otherwise(
                F.lit("adequate")))


def infant_mortality(df: DataFrame, asset_class: str, days_to_first: str, years_to_first: str) -> DataFrame:
    """Per class: assets, failures within the first year and burn-in survivors, with shares."""
    young, old = F.col(days_to_first) < 365, F.col(years_to_first) > 5
    return df.groupBy(asset_class).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(young).alias("n_infant"), F.count_if(old).alias("n_survivors"),
        (F.count_if(young) / F.count(F.lit(1)) * 100.0).alias("infant_pct"),
        (F.count_if(old) / F.count(F.lit(1)) * 100.0).alias("survivor_pct"))


def infant_by(df: DataFrame, key: Column, days_to_first: str) -> DataFrame:
    """Early failures by any key (install year, age source), with the share among all early failures."""
    young = df.filter(F.col(days_to_first) < 365)
    total = young.agg(F.count(F.lit(1)).alias("t")).scalar()
    return young.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n")).withColumn("pct", F.col("n") / total * 100.0)


def by_category(df: DataFrame, category: str, value: str, age: str | None = None) -> DataFrame:
    """Mean, exact median, deviation, extremes and count of a probability per category."""
    aggs = [F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"),
            F.max(value).alias("max"), F.count(F.lit(1)).alias("n")]
    if age is not None:
        aggs.append(F.avg(age).alias("mean_age"))
    stats = df.groupBy(category).agg(*aggs)
    medians = quantiles(df, [value], {"median": 0.5}, by=[category]).drop("column")
    return stats.join(medians, category)


def group_outliers(df: DataFrame, by: str, value: str) -> DataFrame:
    """Deviation from the group mean and a flag beyond two standard deviations.

    The moments are aggregated and joined, not windowed, so a large group stays spread out.
    """
    stats = df.groupBy(by).agg(F.avg(value).alias("expected"), F.stddev_samp(value).alias("_sd"))
    gap = F.col(value) - F.col("expected")
    return df.join(stats, by).withColumns({
        "deviation_pct": F.when(F.col("expected") > 0, gap / F.col("expected") * 100.0).otherwise(F.lit(0.0)),
        "outlier": S.flag((F.col("_sd") > 0) & (F.abs(gap) > 2 * F.col("_sd")))}).drop("_sd")


def prediction_summary(long: DataFrame, horizon: str, probability: str, threshold: float) -> DataFrame:
    """Per horizon of a long (asset, horizon, probability) table: mean, exact median, high-risk count and share."""
    high = F.col(probability) > threshold
    stats = long.groupBy(horizon).agg(
        F.count(probability).alias("n"), F.avg(probability).alias("mean"), F.count_if(high).alias("n_high"),
        (F.count_if(high) / F.count(F.lit(1)) * 100.0).alias("high_pct"))
    return stats.join(quantiles(long, [probability], {"median": 0.5}, by=[horizon]).drop("column"), horizon)


def leakage_correlation(df: DataFrame, target: str, features: Sequence[str]) -> DataFrame:
    """Correlation of each feature with the target, with bands at 0.5 and 0.3."""
    one = df.agg(*[F.corr(F.col(f).cast("double"), F.col(target).cast("double")).alias(f"_r{i}") for i, f in enumerate(features)])
    rows = [F.struct(F.lit(f).alias("feature"), S.finite(F.col(f"_r{i}")).alias("r")) for i, f in enumerate(features)]
    return one.select(F.inline(F.array(*rows))).withColumn(
        "band", F.when(F.abs("r") > 0.5, F.lit("leak")).when(F.abs("r") > 0.3, F.lit("watch")).otherwise(F.lit("fine")))
