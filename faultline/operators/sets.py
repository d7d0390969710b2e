"""Unions of unlike tables, id audits and keyed joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F



def align(df: DataFrame, like: DataFrame, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """The columns of another table in its order; missing ones take a default or are null."""
    defaults = defaults or {}
    have = set(df.columns)
    out = []
    for f in like.schema.fields:
        if f.name in have:
            out.append(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name))
        else:
            out.append(F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name))
    return df.select(*out)


# What a never-failed asset gets for history columns; everything else is missing.
HEALTHY_DEFAULTS = {
    "n_events": 0, "summer_events": 0, "winter_events": 0, "events_3m": 0, "events_6m": 0, "events_12m": 0,
    "recurs_30d": 0, "recurs_90d": 0, "is_degrading": 0, "hazard_rate": 0.0, "has_failure_history": 0,
    "data_source": "Healthy_Equipment",
}


def union_mixed(failed: DataFrame, healthy: DataFrame, defaults: Mapping[str, object] = HEALTHY_DEFAULTS) -> DataFrame:
    """Failed and never-failed assets as one table with the columns of the failed ones and a source mark."""
    marked = failed.withColumns({"has_failure_history": F.lit(1), "data_source": F.lit("Failed_Equipment")})
    return marked.unionByName(align(healthy, marked, defaults))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def id_presence(a: DataFrame, b: DataFrame, key_a: str, key_b: str) -> DataFrame:
    """Every id of either table with its presence in both, from one tagged aggregation."""
    left = a.select(F.col(key_a).alias("id"), F.lit(1).alias("in_a"), F.lit(0).alias("in_b"))
    right = b.select(F.col(key_b).alias("id"), F.lit(0).alias("in_a"), F.lit(1).alias("in_b"))
    return left.unionByName(right).filter(F.col("id").isNotNull()).groupBy("id").agg(
        F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))


def id_audit(a: DataFrame, b: DataFrame, key_a: str, key_b: str) -> DataFrame:
    """Sizes of the intersection and both differences, the match share of the first table and its band."""
    p = id_presence(a, b, key_a, key_b)
    both = F.count_if((F.col("in_a") == 1) & (F.col("in_b") == 1))
    pct = F.try_divide(both, F.sum("in_a")) * 100.0
    return p.agg(
        F.sum("in_a").alias("n_a"), F.sum("in_b").alias("n_b"), both.alias("n_both"),
        F.count_if(F.col("in_b") == 0).alias("n_only_a"), F.count_if(F.col("in_a") == 0).alias("n_only_b"),
        pct.alias("match_pct"),
    ).withColumn("band", F.when(F.col("match_pct") < 95, F.lit("poor")).when(
        F.col("match_pct") < 100, F.lit("partial")).otherwise(F.lit("full")))


def id_mapping(a: DataFrame, b: DataFrame, key_a: str, key_b: str) -> DataFrame:
    p = id_presence(a, b, key_a, key_b).filter((F.col("in_a") == 1) & (F.col("in_b") == 1))
    return p.select(F.col("id").alias("asset"), F.col("id").alias("log_id"))


def attach(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left join to a table with unique keys; the planner picks the strategy and splits skewed keys."""
    return left.join(right, on, "left")


def assemble(base: DataFrame, parts: Sequence[DataFrame], on: str) -> DataFrame:
    """Chained left joins of per-asset tables: all share the key, so the base is shuffled once."""
    return reduce(lambda acc, p: acc.join(p, on, "left"), parts, base)
