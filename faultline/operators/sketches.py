"""Mergeable column sketches: what a profile needs from one pass, in a table that can be stored and added up.

Per column a sketch holds row counts, a HyperLogLog of its values, the state of its most frequent values, the smallest
text and the extremes of its hashes. Partitions, days or files each give a small table; ``merge`` adds such tables, and
``report`` reads them. No value leaves its partition, whatever the number of distinct ones.

Distinct counts are exact while a column has few values (about a thousand) and within about two percent beyond; whether
there is no more than one is always exact, as equal values have equal hashes. The count of the most frequent value is exact
while no more than ``TRACKED`` values are seen, and above one percent of the rows it is off by a few hundredths of
itself at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

#: Registers of the HyperLogLog as a power of two, and how many frequent values are followed.
PRECISION = 14
TRACKED = 1000
#: Columns sketched in one aggregate; a wider table takes a pass for each so many.
WIDTH = 200


def sketch(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, data_type, n_rows, non_null, distinct, frequent, low, high, sample_value``: one row per column."""
    columns = list(df.columns if columns is None else columns)
    out = None
    for start in range(0, len(columns), WIDTH):
        part = columns[start:start + WIDTH]
        aggs = [F.count(F.lit(1)).alias("_n")]
        for i, c in enumerate(part):
            text = F.col(f"`{c}`").cast("string")
            mark = F.when(F.col(f"`{c}`").isNotNull(), F.xxhash64(text))
            aggs += [F.count(F.col(f"`{c}`")).alias(f"_c{i}"), F.hll_sketch_agg(mark, PRECISION).alias(f"_d{i}"),
                     F.call_function("approx_top_k_accumulate", text, F.lit(TRACKED)).alias(f"_f{i}"),
                     F.min(mark).alias(f"_l{i}"), F.max(mark).alias(f"_h{i}"), F.min(text).alias(f"_s{i}")]
        one = df.agg(*aggs)
        rows = [F.struct(F.lit(c).alias("column"), F.lit(df.schema[c].dataType.simpleString()).alias("data_type"), F.col("_n").alias("n_rows"),
                         F.col(f"_c{i}").alias("non_null"), F.col(f"_d{i}").alias("distinct"), F.col(f"_f{i}").alias("frequent"),
                         F.col(f"_l{i}").alias("low"), F.col(f"_h{i}").alias("high"), F.col(f"_s{i}").alias("sample_value"))
                for i, c in enumerate(part)]
        found = one.select(F.inline(F.array(*rows)))
        out = found if out is None else out.unionAll(found)
    return out


def merge(sketches: DataFrame) -> DataFrame:
    """The sketches of several parts of a table as those of the whole; same columns."""
    return sketches.groupBy("column").agg(
        F.min("data_type").alias("data_type"), F.sum("n_rows").alias("n_rows"), F.sum("non_null").alias("non_null"),
        F.hll_union_agg("distinct").alias("distinct"), F.call_function("approx_top_k_combine", F.col("frequent"), F.lit(TRACKED)).alias("frequent"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.min("sample_value").alias("sample_value"))


def report(sketches: DataFrame, top: int = 1) -> DataFrame:
    """``column, data_type, n_rows, non_null, n_distinct, n_most, top_values, sample_value`` from sketches.

    ``n_most`` counts the rows of the most frequent value (0 if none is frequent enough to tell), ``top_values`` lists ``top`` of
    them with their counts.
    """
    found = F.call_function("approx_top_k_estimate", F.col("frequent"), F.lit(top + 1))  # nulls may count as a value
    known = F.slice(F.filter(found, lambda x: x["item"].isNotNull()), 1, top)
    same = F.col("low") == F.col("high")
    # The state of a column without values can't be read.
    some = F.col("non_null") > 0
    distinct = F.when(some & same, F.lit(1)).when(some, F.greatest(F.hll_sketch_estimate("distinct"), F.lit(2))).otherwise(0).cast("bigint")
    return sketches.select(
        "column", "data_type", "n_rows", "non_null", distinct.alias("n_distinct"),
        F.when(some & same, F.col("non_null")).when(some & (F.size(known) == 0), 0).when(some, F.least(F.get(known, F.lit(0))["count"], F.col("non_null"))).alias("n_most"),
        F.when(some, known).alias("top_values"), "sample_value")
