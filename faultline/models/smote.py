"""Minority oversampling by interpolation between nearest neighbours, without comparing all pairs.

Points are placed on a line by a projection that never exceeds their distance, and cut into blocks of
bounded size along it. Neighbours within the block bound the distance to look for; only blocks that
can hold a closer point are compared, block by block. The result is exact.
"""

from __future__ import annotations

import math
import random

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from faultline.operators.ordered import cumulative, with_blocks
from faultline.session import checkpoint


def _search(k: int):
    """Task helper: for every query row its k nearest rows of the other frame, in chunks."""

    def run(queries, points):
        import numpy as np
        import pandas as pd

        columns = ["id", "n_id", "distance"]
        if len(queries) == 0 or len(points) == 0:
            return pd.DataFrame({"id": [], "n_id": [], "distance": []}).astype({"id": "int64", "n_id": "int64", "distance": "float64"})
        q, p = np.stack(queries["x"].to_numpy()), np.stack(points["x"].to_numpy())
        q_id, p_id = queries["id"].to_numpy(), points["id"].to_numpy()
        parts = []
        step = max(1, 4_000_000 // p.size)  # one formula for blocks of any size, at most 32 MB of differences
        for start in range(0, len(q), step):
            chunk, ids = q[start:start + step], q_id[start:start + step]
            d = ((chunk[:, None, :] - p[None, :, :]) ** 2).sum(axis=2)
            d[ids[:, None] == p_id[None, :]] = np.inf
            m = min(k, d.shape[1])
            # Ties are broken by id, so results do not depend on row order.
            best = np.lexsort((np.broadcast_to(p_id, d.shape), d), axis=1)[:, :m]
            rows = np.repeat(ids, m)
            parts.append(pd.DataFrame({"id": rows, "n_id": p_id[best].ravel(),
                                       "distance": np.sqrt(np.take_along_axis(d, best, 1)).ravel()}))
        out = pd.concat(parts)[columns]
        return out[np.isfinite(out["distance"])]

    return run


def _best(candidates: DataFrame, k: int) -> DataFrame:
    """The k nearest per point; a point has at most k candidates per block compared."""
    entry = F.struct("distance", "n_id")
    return candidates.groupBy("id").agg(F.slice(F.array_sort(F.collect_set(entry)), 1, k).alias("near"))


def nearest(points: DataFrame, k: int, block_rows: int = 4000, seed: int = 42) -> DataFrame:
    """(id, near): the k nearest other points of every point, as an array of (distance, n_id).

    ``points`` has a unique bigint ``id`` and an array<double> ``x``. Equal points are found through
    one representative: only distinct vectors enter the search.
    """
    width = len(points.first()["x"])
    rng = random.Random(seed)
    direction = [rng.gauss(0, 1) for _ in range(width)]
    norm = math.sqrt(sum(v * v for v in direction))
    axis = F.array(*[F.lit(v / norm) for v in direction])
    distinct = checkpoint(points.groupBy("x").agg(F.min("id").alias("id")).withColumn(
        "t", F.aggregate(F.zip_with("x", axis, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)))
    n = distinct.count()
    blocks = max(1, -(-n // block_rows))
    placed = checkpoint(with_blocks(distinct, ["t"], ["_b"], blocks).withColumn("block", F.col("_b").cast("int")).drop("_b"))
    schema = "id bigint, n_id bigint, distance double"
    run = _search(k)

    def same_block(key, pdf):
        return run(pdf, pdf)

    def two_blocks(key, left, right):
        return run(left, right.rename(columns={"h_id": "id", "h_x": "x"}))

    inside = checkpoint(placed.groupBy("block").applyInPandas(same_block, schema))
    radius = inside.groupBy("id").agg(F.max("distance").alias("r"), F.count(F.lit(1)).alias("c"))
    reach = placed.join(radius, "id", "left").withColumn(
        "r", F.when(F.col("c") >= k, F.col("r")).otherwise(F.lit(float("inf"))))
    ranges = placed.groupBy("block").agg(F.min("t").alias("lo"), F.max("t").alias("hi")).collect()  # one row per block
    spans = F.array(*[F.struct(F.lit(r["block"]).alias("b"), F.lit(r["lo"]).alias("lo"), F.lit(r["hi"]).alias("hi")) for r in ranges])
    wanted = F.filter(spans, lambda s: (s["b"] != F.col("block")) & (s["lo"] <= F.col("t") + F.col("r")) & (s["hi"] >= F.col("t") - F.col("r")))
    visits = checkpoint(reach.select("id", "x", F.col("block").alias("src"), F.explode(F.transform(wanted, lambda s: s["b"])).alias("dst")))
    pairs = visits.select("src", "dst").distinct()
    hosts = placed.select("id", "x", F.col("block").alias("dst")).join(pairs, "dst").select(
        F.col("src").alias("h_src"), F.col("dst").alias("h_dst"), F.col("id").alias("h_id"), F.col("x").alias("h_x"))
    outside = visits.groupBy("src", "dst").cogroup(hosts.groupBy("h_src", "h_dst")).applyInPandas(two_blocks, schema)
    return _best(inside.unionByName(outside), k)


def smote(train: DataFrame, label: str, entity: str, ratio: float = 0.33, k: int = 5, seed: int = 42) -> DataFrame:
    """Synthetic positives (``features`` as arrays) that bring positives to ``ratio`` times the negatives.

    Every positive gets the same number of new rows, the remainder goes to those first in hash order.
    """
    counts = train.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")).first()
    needed = int(counts["n"] * ratio) - counts["p"]
    minority = checkpoint(train.filter(F.col(label) == 1).select(F.xxhash64(entity).alias("id"), vector_to_array("features").alias("x")))
    if counts["p"] < 2 or needed <= 0:
        return minority.limit(0).select(F.col("x").alias("features"))
    k = min(k, counts["p"] - 1)
    near = nearest(minority, k, seed=seed)
    representatives = minority.groupBy("x").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    base = minority.join(representatives, "x").join(near.withColumnRenamed("id", "rep"), "rep", "left")
    order = cumulative(minority.select(F.xxhash64(F.lit(seed), "id").alias("_h")), "_h").select("_h", F.col("n_before").alias("_pos"))
    each, rest = divmod(needed, counts["p"])
    drawn = base.withColumn("_h", F.xxhash64(F.lit(seed), "id")).join(order, "_h").withColumn(
        "_m", F.lit(each) + (F.col("_pos") < rest).cast("int")).filter("_m > 0").withColumn("draw", F.explode(F.sequence(F.lit(1), F.col("_m"))))
    pick = F.pmod(F.xxhash64(F.lit(seed), "id", "draw"), F.lit(k)).cast("int")
    step = F.pmod(F.xxhash64(F.lit(seed + 1), "id", "draw"), F.lit(1 << 30)) / float(1 << 30)
    # Equal points are each other's nearest neighbours, at distance zero: they come first.
    twins = F.least(F.col("copies") - 1, F.lit(k)).cast("int")
    other = F.try_element_at("near", F.greatest(pick - twins, F.lit(0)) + 1)["n_id"]
    chosen = drawn.select("x", step.alias("s"), F.when(pick < twins, F.col("rep")).otherwise(F.coalesce(other, F.col("rep"))).alias("_n"))
    partners = representatives.select(F.col("rep").alias("_n"), F.col("x").alias("y"))
    new = F.zip_with(F.zip_with("x", "y", lambda a, b: b - a), "x", lambda d, a: a + d * F.col("s"))
    return chosen.join(partners, "_n").select(new.alias("features"))


def recommendation(auc_with: float, auc_without: float, margin: float = 0.02) -> str:
    if auc_with > auc_without + margin:
        return "Use SMOTE"
    return "Don't use SMOTE" if auc_with < auc_without - margin else "SMOTE not necessary"
