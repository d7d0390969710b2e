"""Expressions and helpers the operators share: words of a text, local bindings, tables kept in the shared folder."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.session import scratch_folder

#: ASCII white space between words, for Java's and for RE2's pattern language alike.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text as an array; none for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), "")


def keep(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: it is computed once and its lineage ends there."""
    folder = scratch_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def numbered(docs: DataFrame) -> DataFrame:
    """``_doc, _row``: the rows as structs, each with a number of its own, written once so that the numbers stay the same."""
    return keep(docs.select(F.struct("*").alias("_doc"), F.monotonically_increasing_id().alias("_row")))


_SPACES = re.compile(rb"[\x20\x09-\x0D]")


def word_chunks(data: bytes, size: int = 1 << 20, lower: bool = True) -> Iterator[list[bytes]]:
    """The words of a text in UTF-8, A-Z lower-cased, in lists of bounded size: cut at white space every ``size`` bytes."""
    at = 0
    while at < len(data):
        space = _SPACES.search(data, min(len(data), at + size))
        end = space.start() if space else len(data)
        part = data[at:end]
        yield (part.lower() if lower else part).split()
        at = end
