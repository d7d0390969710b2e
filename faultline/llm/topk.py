"""Exact top-k search by distributed histogram selection.

Vectors become whole numbers, so scores are exact. Queries are taken in batches of bounded size; every batch is scored
against all rows where they lie. The first passes count scores in histograms that become finer around each query's k-th
best value: a pass splits the value's bin and adds up the counts of all partitions, until a bin is one score. The last
pass filters by that score and orders what is left by score and id.

A block of rows counts its own k best of the open bin only: the k-th best of all rows is never below that of a block.

Rows whose vector is null, empty or holds null or non-finite components take no part. Only vectors of the same length are
compared. Scores fit in 64 bits; one that doesn't raises an error. A query's own row is every row with its id; repeated rows with another id are candidates each, and a repeated
query is answered once, with its smallest vector. A null id is no query; as a candidate it comes after all ids. Fewer candidates than k: all of
them. Empty tables give an empty result. Other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.common import keep

K = 5
EVERY = 50
SCALE = 256
#: A histogram pass splits a bin in 2^11; a batch of queries holds at most so many numbers, a block of scores as well.
BITS = 11
BATCH_CELLS = 1 << 20
BLOCK_CELLS = 1 << 22

NO_ID = (1 << 63) - 1
NO_SCORE = -(1 << 63)


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(fine, F.lit(False))


def _scores(batches: Iterator[pd.DataFrame], ids: np.ndarray, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (candidate ids, scores of queries by candidates); a query's own rows score ``NO_SCORE``."""
    n, width = queries.shape
    step = max(16, BLOCK_CELLS // max(n, 1))
    top = float(np.abs(queries).max(initial=0))
    for pdf in batches:
        for at in range(0, len(pdf), step):
            part = pdf.iloc[at:at + step]
            block = np.stack(part["v"].to_numpy()).astype(np.int64)
            own = part["id"].to_numpy(np.int64)
            if top * float(np.abs(block).max(initial=0)) * width < 2 ** 53:
                scores = (queries.astype(np.float64) @ block.T.astype(np.float64)).astype(np.int64)
            else:  # beyond what doubles hold exactly; an overflow of the result raises
                scores = (queries.astype(object) @ block.T.astype(object)).astype(np.int64)
            scores[ids[:, None] == own[None, :]] = NO_SCORE
            yield own, scores


def _count(batches: Iterator[pd.DataFrame], ids: np.ndarray, queries: np.ndarray, base: np.ndarray, width: np.ndarray,
           shift: int, k: int) -> Iterator[pd.DataFrame]:
    """Histogram rows (query, bin, n) of the scores in each query's open bin [base, base + width)."""
    for _, scores in _scores(batches, ids, queries):
        above = scores.view(np.uint64) - base.view(np.uint64)[:, None]
        inside = (scores >= base[:, None]) & (above < width[:, None])
        bins = np.where(inside, (above >> np.uint64(shift)).view(np.int64), -1)
        if bins.shape[1] > k:
            bins = np.partition(bins, bins.shape[1] - k, axis=1)[:, -k:]
        rows, cols = np.nonzero(bins >= 0)
        keys, n = np.unique((rows.astype(np.int64) << (BITS + 1)) | bins[rows, cols], return_counts=True)
        yield pd.DataFrame({"q": keys >> (BITS + 1), "bin": keys & ((1 << (BITS + 1)) - 1), "n": n})


def _select(batches: Iterator[pd.DataFrame], ids: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int) -> Iterator[pd.DataFrame]:
    for own, scores in _scores(batches, ids, queries):
        rows, cols = np.nonzero(scores >= least[:, None])
        order = np.lexsort((own[cols], -scores[rows, cols], rows))
        rows, cols = rows[order], cols[order]
        first = np.searchsorted(rows, rows, side="left")
        best = np.arange(len(rows)) - first < k
        rows, cols = rows[best], cols[best]
        yield pd.DataFrame({"query_id": ids[rows], "vec_id": own[cols], "score": scores[rows, cols]})


def search(vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """The k best scores of every row whose id is divisible by ``every``, over all other rows."""
    spark = vectors.sparkSession
    v = F.col(vector_col)
    clean = keep(vectors.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
                                F.when(usable(v), whole_numbers(v, scale)).alias("v")).where("v is not null"))
    asked = keep(clean.where((F.col("id") % every == 0) & (F.col("id") != NO_ID)).groupBy("id").agg(F.min("v").alias("v"))
                 .select("id", "v", F.size("v").alias("width")))
    shapes = asked.groupBy("width").agg(F.count("*").alias("n")).collect()  # one row for each length of vectors
    out = None
    for width, n in sorted(shapes):
        rows = clean.where(F.size("v") == width)
        peak = rows.select(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)).alias("m")).first()["m"]
        waves = -(-n * width // BATCH_CELLS)
        for wave in range(waves):
            chosen = asked.where((F.col("width") == width) & (F.pmod(F.xxhash64("id"), F.lit(waves)) == wave)).select("id", "v").toPandas()
            if len(chosen) == 0:
                continue
            ids, queries = chosen["id"].to_numpy(np.int64), np.stack(chosen["v"].to_numpy()).astype(np.int64)
            part = _search_batch(rows, ids, queries, peak, k)
            out = part if out is None else out.unionAll(part)
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.nullif("vec_id", F.lit(NO_ID)).alias("vec_id"), "score")


def _search_batch(rows: DataFrame, ids: np.ndarray, queries: np.ndarray, peak: float, k: int) -> DataFrame:
    bound = min(int(peak * 1.000001) + 1, -NO_SCORE - 1)  # no score is larger, by Cauchy and Schwarz
    total = bound.bit_length() + 1
    base, width = np.full(len(ids), -bound, np.int64), np.full(len(ids), 2 * bound + 1, np.uint64)
    wanted = np.full(len(ids), k, np.int64)
    for shift in range(max(0, total - BITS), -BITS, -BITS):
        shift = max(shift, 0)
        counted = rows.mapInPandas(lambda it, b=base, w=width, s=shift: _count(it, ids, queries, b, w, s, k), "q long, bin long, n long")
        need = rows.sparkSession.createDataFrame(pd.DataFrame({"q": np.arange(len(ids)), "wanted": wanted}))
        down = Window.partitionBy("q").orderBy(F.col("bin").desc())
        upto = counted.groupBy("q", "bin").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(down))
        found = upto.join(need, "q").where("upto >= wanted and upto - n < wanted").select("q", "bin", F.expr("wanted - upto + n").alias("wanted"))
        found = found.toPandas()  # one row for each query of the batch
        q, at = found["q"].to_numpy(np.int64), found["bin"].to_numpy(np.uint64)
        few = np.setdiff1d(np.arange(len(ids)), q)  # with less than k candidates all are taken
        base[few], width[few] = NO_SCORE + 1, 0
        base[q] = (base[q].view(np.uint64) + (at << np.uint64(shift))).view(np.int64)
        width[q], wanted[q] = np.uint64(1 << shift), found["wanted"].to_numpy(np.int64)
        if shift == 0:
            break
    return rows.mapInPandas(lambda it: _select(it, ids, queries, base, k), "query_id long, vec_id long, score long")


def sql(table: str = "embeddings", k: int = K, every: int = EVERY, scale: int = SCALE) -> str:
    return f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM {table}
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % {every} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= {k}"""
