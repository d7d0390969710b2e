"""Bounded, reproducible samples of labelled rows for fitting, and one task to fit in."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.common import keep


def fold(key: Column, folds: int) -> Column:
    """The fold of a row by the CRC-32 of its id as text; null for a null id."""
    return (F.crc32(key.cast("string").cast("binary")) % folds).cast("int")


def bounded(rows: DataFrame, label: str, key: str, per_label: int, most: int, seed: str) -> DataFrame:
    """About ``per_label`` rows of each label, chosen by a hash of their id, and about ``most`` in all.

    Labels are counted first; a row is taken if its hash lies below its label's share. Where the labels are too many for
    ``per_label`` of each, all get the same smaller number, so none is lost; labels beyond ``most``, the rarest, are.
    No label is sorted or gathered.
    """
    counts = rows.groupBy(F.col(label).alias("_label")).agg(F.count("*").alias("_n"))
    counted = keep(counts.where("_label is not null").orderBy(F.col("_n").desc(), "_label").limit(most))
    share = min(per_label, max(1, most // max(1, counted.count())))
    place = F.shiftright(F.xxhash64(F.lit(seed), F.col(key)), 1).cast("double") / float(1 << 63) + 0.5
    drawn = rows.join(F.broadcast(counted), F.col(label) == F.col("_label")).withColumn("_place", place)
    # Shares are met on average; a margin of five deviations is kept, so that what is over goes by rank within its label.
    rank = F.row_number().over(Window.partitionBy("_label").orderBy("_place", key))
    near = drawn.where(F.col("_place") * F.col("_n") < share + 5 * share ** 0.5)
    return near.withColumn("_rank", rank).where(F.col("_rank") <= share).orderBy("_place", key).limit(most).drop("_label", "_n", "_place", "_rank")


def fit_in_task(rows: DataFrame, fit: Callable[[pd.DataFrame], bytes]) -> bytes | None:
    """``fit`` applied to a bounded table in one task of the cluster; None for an empty table."""
    kept = keep(rows)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"model": [fit(pdf)]})

    found = kept.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(run, "model binary").collect()
    return bytes(found[0]["model"]) if found else None
