"""Label encoding in alphabetical order and back, without gathering the labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from faultline.functions.scalars import null_text
from faultline.session import checkpoint


def label_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, code): codes 0, 1, .. in the order of the text, a missing value being the text 'nan'.

    The distinct labels are range-sorted and written once; a label's code is its position in its
    partition plus the sizes of the partitions before it.
    """
    pairs = [F.struct(F.lit(c).alias("column"), null_text(c).alias("value")) for c in columns]
    labels = df.select(F.inline(F.array(*pairs))).distinct().sort("column", "value")
    placed = checkpoint(labels.withColumn("_m", F.monotonically_increasing_id()))
    part, position = F.shiftright("_m", 33), F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition of the sort.
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part").select(
        "column", "value", (F.col("_offset") + position).alias("_pos"))
    starts = numbered.groupBy("column").agg(F.min("_pos").alias("_start"))  # one row per encoded column
    return numbered.join(F.broadcast(starts), "column").select("column", "value", (F.col("_pos") - F.col("_start")).alias("code"))


def encode(df: DataFrame, columns: Sequence[str], suffix: str = "_code", codes: DataFrame | None = None) -> DataFrame:
    """Add ``<column>_code``; labels unknown to the given codes get null."""
    if not columns:
        return df
    codes = label_codes(df, columns) if codes is None else codes
    out = df
    for c in columns:
        one = codes.filter(F.col("column") == c).select(F.col("value").alias("_label"), F.col("code").cast("double").alias(f"{c}{suffix}"))
        out = out.withColumn("_label", null_text(c)).join(one, "_label", "left").drop("_label")
    return out


def decode(df: DataFrame, column: str, codes: DataFrame, source: str, out: str) -> DataFrame:
    """The label of a code of ``source``."""
    one = codes.filter(F.col("column") == source).select(F.col("code").cast("double").alias("_c"), F.col("value").alias(out))
    return df.withColumn("_c", F.col(column).cast("double")).join(one, "_c", "left").drop("_c")
