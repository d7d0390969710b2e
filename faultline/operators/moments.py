"""Sums of products of all column pairs from one scan: every task adds up p x p blocks, which are added by cell.

A value that is missing, or not finite, leaves out the pairs it belongs to, and only those. Values are taken relative to
one of their column, so that large offsets (timestamps, identifiers) cost no digits; ``gram`` puts them back.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

CELL = "i int, j int, n long, s_i double, s_j double, q_i double, q_j double, g double"


def offsets(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """One finite value of each column, from a bounded number of rows; 0 where they have none."""
    found = np.zeros(len(columns))
    for row in reversed(df.select(*[F.col(f"`{c}`").cast("double") for c in columns]).limit(100).collect()):
        for i, v in enumerate(row):
            if v is not None and np.isfinite(v):
                found[i] = v
    return found


def pair_sums(df: DataFrame, columns: Sequence[str], shift: np.ndarray | None = None) -> DataFrame:
    """``i, j, n, s_i, s_j, q_i, q_j, g`` for i <= j: rows that have both columns, sums, sums of squares and of products."""
    shift = offsets(df, columns) if shift is None else shift
    p = len(columns)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q, g = (np.zeros((p, p)) for _ in range(4))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]) - shift
            there = np.isfinite(x)
            x = np.where(there, x, 0.0)
            there = there.astype(float)
            n += there.T @ there
            s += x.T @ there
            q += (x * x).T @ there
            g += x.T @ x
        i, j = np.triu_indices(p)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(n[i, j].astype(np.int64)), pa.array(s[i, j]), pa.array(s[j, i]),
             pa.array(q[i, j]), pa.array(q[j, i]), pa.array(g[i, j])], names=["i", "j", "n", "s_i", "s_j", "q_i", "q_j", "g"])

    named = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    return named.mapInArrow(added, CELL).groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "s_i", "s_j", "q_i", "q_j", "g")])


def correlation() -> Column:
    """Pearson correlation of a cell; null with fewer than two rows or a constant side."""
    n = F.col("n")
    v_i, v_j = (F.col(f"q_{k}") - F.col(f"s_{k}") * F.col(f"s_{k}") / n for k in "ij")
    some = (n > 1) & (v_i > 1e-13 * F.col("q_i")) & (v_j > 1e-13 * F.col("q_j"))
    r = (F.col("g") - F.col("s_i") * F.col("s_j") / n) / (F.sqrt(v_i) * F.sqrt(v_j))
    return F.when(some, F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0)))


def gram(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Sums of products of all column pairs as a matrix; one row a cell reaches the driver."""
    shift = offsets(df, columns)
    out = np.zeros((len(columns), len(columns)))
    for r in pair_sums(df, columns, shift).collect():
        value = r["g"] + shift[r["j"]] * r["s_i"] + shift[r["i"]] * r["s_j"] + r["n"] * shift[r["i"]] * shift[r["j"]]
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = value
    return out
