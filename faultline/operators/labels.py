"""Labels: which assets fail again after the cutoff, and how labels relate to the asset table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from faultline import config
from faultline.functions import scalars as S
from faultline.functions.dates import moment


def horizon_end(cutoff: str, months: int):
    return moment(cutoff).cast("timestamp_ntz") + F.make_interval(months=F.lit(months))


def horizon_ids(events: DataFrame, entity: str, ts: str, cutoff: str, months: int) -> DataFrame:
    """Distinct assets with an event in (cutoff, cutoff + months]."""
    inside = (F.col(ts) > moment(cutoff)) & (F.col(ts) <= horizon_end(cutoff, months))
    return events.filter(inside & F.col(entity).isNotNull()).select(entity).distinct()


def first_future_event(events: DataFrame, entity: str, ts: str, cutoff: str, months: int) -> DataFrame:
    """The earliest event after the cutoff per asset, within the longest horizon: enough for every label."""
    inside = (F.col(ts) > moment(cutoff)) & (F.col(ts) <= horizon_end(cutoff, months))
    return events.filter(inside & F.col(entity).isNotNull()).groupBy(entity).agg(F.min(ts).alias("_next_event"))


def make_targets(
    assets: DataFrame, events: DataFrame, entity: str, ts: str, cutoff: str,
    horizons: Mapping[str, int] = config.HORIZON_MONTHS,
) -> DataFrame:
    """0/1 label per horizon for every asset, from one pass over the future events and one join."""
    soonest = first_future_event(events, entity, ts, cutoff, max(horizons.values()))
    joined = assets.select(entity).join(soonest, entity, "left")
    return joined.select(entity, *[
        S.flag(F.col("_next_event") <= horizon_end(cutoff, m)).alias(f"target_{h}") for h, m in horizons.items()])


def unmatched_ids(assets: DataFrame, events: DataFrame, entity: str, ts: str, cutoff: str, months: int) -> DataFrame:
    """Assets that fail in the horizon but are missing from the asset table."""
    future = horizon_ids(events, entity, ts, cutoff, months)
    return future.join(assets.select(entity).distinct(), entity, "left_anti")


def lifetime_target(assets: DataFrame, count: str, at_least: int = 2) -> DataFrame:
    return assets.withColumn("target_lifetime", S.flag(F.col(count) >= at_least))


def chronic_target(assets: DataFrame, recurrence: str = "recurs_90d") -> DataFrame:
    """Repeat failures of the assets that failed at all."""
    failed = assets.filter(~S.healthy_mask(assets.columns))
    return failed.withColumn("target_chronic", S.flag(F.col(recurrence) == 1))


def long_targets(targets: DataFrame, entity: str, horizons=config.HORIZON_MONTHS) -> DataFrame:
    pairs = [F.struct(F.lit(h).alias("horizon"), F.col(f"target_{h}").alias("target")) for h in horizons]
    return targets.select(entity, F.inline(F.array(*pairs)))


def expect(value_rows: DataFrame, value: str, low: float, high: float, check: str) -> DataFrame:
    """Plausibility check of a report value as a pass/warn row."""
    ok = F.col(value).between(low, high)
    return value_rows.select(F.lit(check).alias("check"), F.col(value).cast("double").alias("value"),
                             F.lit(float(low)).alias("low"), F.lit(float(high)).alias("high"),
                             F.when(ok, F.lit("pass")).otherwise(F.lit("warn")).alias("status"))


def expect_count(value_rows: DataFrame, value: str, target: float, tolerance: float, check: str) -> DataFrame:
    return expect(value_rows, value, target - tolerance, target + tolerance, check)
