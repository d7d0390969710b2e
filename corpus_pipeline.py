"""The corpus pipeline: quality rules, line dedup, near-dedup, mixing and packing, each on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from faultline.llm import golay, lines, mixing, packing, rules
from faultline.llm.common import keep

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule go."""
    return rules.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One occurrence of each group of like lines stays; a document that loses all its words goes."""
    return lines.deduplicated(docs, short_lines=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return golay.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay as often as the mix takes them; a repeated one is a repeated row."""
    return mixing.mixed_documents(docs)


def token_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("token_packing", token_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written as Parquet and read again for the next."""
    out = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = keep(stage(spark, out, sf_dir))
    return out


#: Line dedup, near-dedup and packing hash words and encode tokens in ways that SQL has no functions for.
ORACLE_SQL = None
