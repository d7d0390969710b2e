"""Mixing sources to target weights with hash-threshold histograms.

A source takes documents in the order of a hash of their id until its target is met. The place where it is met is found
without sorting: words are summed by source and hash bucket, the running sum shows the bucket in which the target falls,
and only that bucket is cut into finer ones, until it holds one hash value. Then one comparison per document decides.

A target above the source's size takes every document once first and the rest from the hash order. Documents that share
the last hash value (one document, or rows with the same id) take what is left in proportion to their sizes, so a
source's taken words miss its target by rounding only.

Null texts have size 0 and take nothing. Null sources form one group, last in order. Null ids hash as the empty text.
Repeated rows are documents of their own. Empty tables give an empty result; an empty source has target 0. Other columns
may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.common import WORD, keep

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST = 2
SEED = "mix"

#: A hash has 60 bits; every level of histograms looks at 10 more.
BITS = 60
STEP = 10


def text_size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"{WORD}+")), F.lit(0)).cast("long")


def hash_of(key: Column, seed: str = SEED) -> Column:
    """60 bits of a digest of the id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def group_of(source: Column) -> Column:
    """The source as a join key that is never null."""
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source.cast("string")))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, most: float = MOST) -> DataFrame:
    """Each source's share of the budget by weight, no more than ``most`` times its size; the excess goes to the others.

    ``sizes``: one row per source with ``grp``, ``source``, ``source_size``. The sources that end at their cap are those
    with the least cap per weight, so running sums over that order give the level all others share. One row per source
    goes through these two windows, not the documents.
    """
    every = Window.partitionBy()
    ranked = sizes.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1)
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.col("place") % len(weights) + 1)
    ranked = ranked.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    level = ((F.sum("source_size").over(every) * budget - F.coalesce(F.sum("cap").over(order.rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))) / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    ranked = ranked.withColumn("level", level)
    free = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "place", "level"))).over(every)
    share = F.coalesce(free["level"] * F.col("weight"), F.col("cap").cast("double"))
    return ranked.select("grp", "source_size", F.least(F.col("cap").cast("double"), share).alias("target"))


def thresholds(sized: DataFrame, goal: DataFrame) -> DataFrame:
    """Per source: how often every document is taken, the hash below which it is taken once more, and what the
    documents at that hash share. ``sized``: grp, size, h; ``goal``: grp, source_size, target."""
    base = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    state = goal.select("*", base.alias("base"), F.lit(0).cast("long").alias("prefix"),
                        F.lit(0).cast("long").alias("before"), (F.col("target") - base * F.col("source_size")).alias("rest"))
    for left in range(BITS - STEP, -1, -STEP):
        rows = sized if left == BITS - STEP else sized.join(state.select("grp", "prefix"), "grp").where(
            F.shiftright("h", left + STEP) == F.col("prefix"))
        buckets = rows.groupBy("grp", F.shiftright("h", left).alias("bucket")).agg(
            F.sum("size").alias("own"), F.min("h").alias("first"), F.max("h").alias("last"))
        upto = F.sum("own").over(Window.partitionBy("grp").orderBy("bucket"))
        below = F.col("before") + F.col("upto") - F.col("own")
        placed = buckets.withColumn("upto", upto).join(state.select("grp", "before", "rest"), "grp").where(
            (below <= F.col("rest")) & (F.col("rest") < below + F.col("own")))
        state = keep(placed.select("grp", F.col("bucket").alias("prefix"), below.alias("before"), "rest", "own", "first", "last"))
        if state.where("first < last").isEmpty():
            break
    return state.select("grp", F.col("first").alias("at"), (F.col("rest") - F.col("before")).alias("rest"), "own")


def plan(docs: DataFrame, source_col: str, id_col: str, text_col: str, **options) -> tuple[DataFrame, DataFrame]:
    """The sized documents (row by row: doc_id, grp, size, h) and the rule of each source."""
    sized = keep(docs.select(F.col(id_col).alias("doc_id"), group_of(F.col(source_col)).alias("grp"),
                             F.col(source_col).cast("string").alias("source"), text_size(F.col(text_col)).alias("size"),
                             hash_of(F.col(id_col)).alias("h")))
    goal = keep(targets(sized.groupBy("grp").agg(F.min("source").alias("source"), F.sum("size").alias("source_size")), **options))
    base = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rule = keep(goal.join(thresholds(sized.select("grp", "size", "h"), goal), "grp", "left").withColumn("base", base))
    return sized.drop("source"), rule


def mix(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document: its size, its source's size and target, and the words of it that the mix takes."""
    sized, rule = plan(docs, source_col, id_col, text_col, **options)
    part = F.when(F.col("h") < F.col("at"), F.col("size")).when(
        F.col("h") == F.col("at"), F.floor(F.col("size") * F.col("rest") / F.col("own"))).otherwise(0)
    return sized.join(rule, "grp").select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("base") + part).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents of the mix with their own columns, a row for each time that one is taken.

    The document at the last hash is taken once more if at least half of it is.
    """
    _, rule = plan(docs, source_col, id_col, text_col, **options)
    once = F.when(F.col("_h") < F.col("at"), 1).when(F.col("_h") == F.col("at"), (2 * F.col("rest") >= F.col("own")).cast("int")).otherwise(0)
    rule = rule.select(F.col("grp").alias("_grp"), "base", "at", "rest", "own")
    named = docs.select(F.struct("*").alias("_doc"), group_of(F.col(source_col)).alias("_grp"), hash_of(F.col(id_col)).alias("_h"))
    times = named.join(rule, "_grp").select("_doc", (F.col("base") + once).cast("int").alias("_n"))
    return times.where("_n > 0").select("_doc", F.explode(F.sequence(F.lit(1), F.col("_n")))).select("_doc.*")


def sql(table: str = "documents", weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, most: float = MOST) -> str:
    """``mix`` for DuckDB, where documents are sorted by their hash."""
    return rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}+'))::BIGINT AS size,
         ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM {table}),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS place FROM s),
w AS (SELECT *, ({list(map(float, weights))})[place % {len(weights)} + 1] AS weight, {most} * source_size AS cap FROM r),
l AS (
  SELECT *, (sum(source_size) OVER () * {budget}::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, place
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE) / sum(weight) OVER (ORDER BY cap / weight, place
         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
f AS (SELECT first(level ORDER BY cap / weight, place) AS free FROM l WHERE level * weight <= cap),
t AS (SELECT source, source_size, least(cap::DOUBLE, coalesce(free * weight, cap::DOUBLE)) AS target FROM l LEFT JOIN f ON true),
b AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS base FROM t),
g AS (SELECT source, h, sum(size) AS own FROM d GROUP BY source, h),
c AS (SELECT *, sum(own) OVER (PARTITION BY source ORDER BY h) - own AS below FROM g)
SELECT d.doc_id, d.size, b.source_size, b.target,
       (d.size * b.base + CASE WHEN c.below + c.own <= b.target - b.base * b.source_size THEN d.size
         WHEN c.below <= b.target - b.base * b.source_size THEN floor(d.size * (b.target - b.base * b.source_size - c.below) / c.own)
         ELSE 0 END)::BIGINT AS taken
FROM d JOIN b ON b.source IS NOT DISTINCT FROM d.source
JOIN c ON c.source IS NOT DISTINCT FROM d.source AND c.h = d.h"""
