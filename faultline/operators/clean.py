"""Filters, deduplication and audit branches of the event log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from faultline.functions.dates import micros, moment
from faultline.operators.ordered import first_rows


def require_id(df: DataFrame, entity: str) -> DataFrame:
    return df.filter(F.col(entity).isNotNull())


def id_coverage(df: DataFrame, entity: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(entity).alias("n_kept"),
        F.count_if(F.col(entity).isNull()).alias("n_dropped"),
        F.count_distinct(entity).alias("n_entities"),
    )


def split(df: DataFrame, rejected: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected); an unknown condition keeps the row."""
    bad = F.coalesce(rejected, F.lit(False))
    return df.filter(~bad), df.filter(bad)


def dedup_exact(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def dedup_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row of every key. ``order`` must be total over the rows that differ."""
    return first_rows(df, keys, order)


def removed_duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows ``dedup_by_key`` drops, equal rows counted in ``copies``.

    Only keys that repeat are looked at again: where they are few the second pass is a filter without a
    shuffle. Equal rows are counted map-side, so a key with many copies is a few counted rows.
    """
    columns = df.columns
    rank = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    repeated = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.count(F.lit(1)).alias("_n"), F.min(rank).alias("_kept")).filter(F.col("_n") > 1).drop("_n")
    same_key = None
    for i, k in enumerate(keys):
        same = F.col(k).eqNullSafe(F.col(f"_k{i}"))
        same_key = same if same_key is None else same_key & same
    marked = df.join(repeated, same_key).select(*columns, rank.eqNullSafe(F.col("_kept")).alias("_is_kept"))
    counted = marked.groupBy(*columns, "_is_kept").agg(F.count(F.lit(1)).alias("copies"))
    left = F.col("copies") - F.col("_is_kept").cast("bigint")
    return counted.select(*columns, left.alias("copies")).filter(F.col("copies") > 0)


def duplicate_split(df: DataFrame, ts: str, cutoff: str, entity: str, copies: str = "copies") -> DataFrame:
    """Removed duplicates on each side of the cutoff."""
    before = F.col(ts) <= moment(cutoff)
    return df.agg(
        F.coalesce(F.sum(F.when(before, F.col(copies))), F.lit(0)).alias("pre_cutoff"),
        F.coalesce(F.sum(F.when(~before, F.col(copies))), F.lit(0)).alias("post_cutoff"),
        F.count_distinct(F.when(~before, F.col(entity))).alias("post_cutoff_entities"),
    )


def before_install(ts: str, install: str) -> Column:
    return micros(ts) < micros(install)


def exclude_before_install(df: DataFrame, ts: str, install: str) -> tuple[DataFrame, DataFrame]:
    return split(df, before_install(ts, install))


def negative_duration(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.agg(
        F.count_if(micros(end) < micros(start)).alias("n_negative"),
        F.count_if(F.col(start).isNotNull() & F.col(end).isNotNull()).alias("n_checked"),
    )


def history(df: DataFrame, ts: str, cutoff: str) -> DataFrame:
    """Events up to and at the cutoff; the comparison reaches the scan."""
    return df.filter(F.col(ts) <= moment(cutoff))


def future(df: DataFrame, ts: str, cutoff: str) -> DataFrame:
    return df.filter(F.col(ts) > moment(cutoff))


def valid_duration(df: DataFrame, minutes: str, longest: float) -> DataFrame:
    return df.filter((F.col(minutes) > 0) & (F.col(minutes) < longest))


def above(df: DataFrame, column: str, threshold: float) -> DataFrame:
    return df.filter(F.col(column) > threshold)


def generated_ids(df: DataFrame, entity: str, marker: str = "UNKNOWN") -> DataFrame:
    return df.filter(F.col(entity).cast("string").contains(marker))


def admit_healthy(
    assets: DataFrame, entity: str, install: str, cutoff: str, order: Sequence[str], life: str | None = None
) -> DataFrame:
    """Assets fit to serve as the never-failed group: id present, first row of an id, installed by the cutoff."""
    unique = first_rows(assets.filter(F.col(entity).isNotNull()), [entity], order)
    admitted = unique.filter(F.col(install).isNotNull() & (F.col(install) <= moment(cutoff)))
    return admitted if life is None else admitted.filter(F.col(life) > 0)


def without(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key never occurs in the other table; its keys are made distinct before they meet."""
    return df.join(other.select(key).filter(F.col(key).isNotNull()).distinct(), key, "left_anti")


def stage_counts(
    df: DataFrame, entity: str, keys: Sequence[str], order: Sequence[str], filters: Sequence[tuple[str, Column]],
    start: str = "all", unique: str = "deduplicated",
) -> DataFrame:
    """Rows and distinct assets after each stage and the share of assets lost since the first one.

    The stages are all rows, the first row of every key, and then the named conditions one after another; a row stays
    while its condition is true. A kept row carries the last stage it reaches, an asset counts at every stage up to the last that
    any of its rows reaches: the log is read once. ``keys`` hold the asset; ``order`` must be total over rows of a
    key that differ in a condition.
    """
    if entity not in keys:
        raise ValueError(f"{entity} must be one of the keys")
    names = [start, unique, *[name for name, _ in filters]]
    reach = F.lit(len(names) - 1)
    for i, (_, kept) in reversed(list(enumerate(filters, 1))):
        reach = F.when(kept, reach).otherwise(F.lit(i))
    rest = [c for c in order if c not in keys]
    first = df.withColumn("_reach", reach).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct(*rest, "_reach")).getField("_reach").alias("_reach"))
    at = [F.sum("_n"), *[F.count_if(F.col("_reach") >= i) for i in range(1, len(names))]]
    assets = first.groupBy(entity).agg(F.max("_reach").alias("_reach"), *[x.alias(f"_r{i}") for i, x in enumerate(at)])
    known = F.col(entity).isNotNull()
    total = assets.agg(
        *[F.coalesce(F.sum(f"_r{i}"), F.lit(0)).alias(f"_r{i}") for i in range(len(names))],
        *[F.count_if(known & (F.col("_reach") >= i)).alias(f"_a{i}") for i in range(len(names))])
    rows = [F.struct(F.lit(i).alias("step"), F.lit(name).alias("stage"), F.col(f"_r{i}").alias("n_rows"), F.col(f"_a{i}").alias("n_assets"))
            for i, name in enumerate(names)]
    lost = (F.lit(1.0) - F.try_divide(F.col("n_assets"), F.col("_a0"))) * 100.0
    return total.select("_a0", F.inline(F.array(*rows))).select("step", "stage", "n_rows", "n_assets", lost.alias("lost_pct"))
