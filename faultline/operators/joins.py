"""Joins that stay even when a few keys hold most rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys of more than one in so many rows are heavy; there are never more of them than this.
HEAVY = 1024


def heavy_join(rows: DataFrame, table: DataFrame, on: Sequence[str], weight: str = "n", most: int = HEAVY) -> DataFrame:
    """Every row with the other columns of ``table``, which holds each key once and in ``weight`` how many rows have it.

    Keys that more than one in ``most`` rows have are at most ``most`` in number: they are taken out of the join and answered
    from a broadcast map. The others are joined, none of them large. Rows with a null key or an unknown one get nulls. Both
    tables are read more than once.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    often = F.coalesce(F.col(weight).cast("double") * most > float(total), F.lit(False))
    more = [c for c in table.columns if c not in on]
    names = [*rows.columns, *more]
    known = reduce(and_, [F.col(c).isNotNull() for c in on])
    some, heavy = rows.where(known), table.where(often)
    mapped = some.join(F.broadcast(heavy), list(on)).select(*names)
    rest = some.join(F.broadcast(heavy.select(*on)), list(on), "left_anti").join(table.where(~often), list(on), "left").select(*names)
    none = rows.where(~known).select(*rows.columns, *[F.lit(None).cast(table.schema[c].dataType).alias(c) for c in more])
    return mapped.unionAll(rest).unionAll(none)
