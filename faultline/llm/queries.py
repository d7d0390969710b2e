"""The registered queries of this folder, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from faultline.llm import align, audit, golay, langid, licenses, lines, mixing, packing, quality, rules, sharding, topk, vectors

#: Small enough that shards split on the tables at hand.
SHARD_BYTES = 1 << 18

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"))


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op3_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines.line_groups(_table(spark, folder, "documents"))


def op4_golay(spark: SparkSession, folder: str) -> DataFrame:
    return golay.near_duplicates(_table(spark, folder, "documents"))


def op5_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(_table(spark, folder, "embeddings"))


def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shards(_table(spark, folder, "documents"), SHARD_BYTES)


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"))


def op8_langid(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(_table(spark, folder, "documents"))


def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(_table(spark, folder, "documents"))


def op10_rules(spark: SparkSession, folder: str) -> DataFrame:
    counted = rules.apply_rules(_table(spark, folder, "documents"))
    return counted.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align.align(_table(spark, folder, "documents"))


def op12_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(_table(spark, folder, "embeddings"))


def op13_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit.audit(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_mixing, op2_quality, op3_lines, op4_golay, op5_topk, op6_sharding, op7_packing, op8_langid, op9_licenses, op10_rules, op11_alignment, op12_vectors, op13_audit)}
SQL: dict[str, str] = {"op1_mixing": mixing.sql(), "op5_topk": topk.sql(), "op6_sharding": sharding.sql(limit=SHARD_BYTES), "op10_rules": rules.sql(), "op13_audit": audit.sql()}
