"""Order-dependent operators that stay distributed whatever the key distribution.

Two devices replace the plain window over a key:

* per-entity order: a window runs inside (entity, calendar block); one small row per block carries
  the state across blocks. A hot entity is spread over its blocks, a hot block is cut at quantiles of
  its instants, and equal instants are counted first, so no task ever holds a whole entity.
* global order: values are counted, cut into blocks of bounded size at approximate quantiles, and
  cumulative sums inside a block are shifted by the totals of the blocks before it. There is at most
  one total per (group, block).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from faultline.functions.dates import elapsed_days, micros

#: A block with more than one in ``HOT_SHARE`` of all instants, and at least ``HOT_FROM`` of them, is cut into ``PIECES``. There
#: are at most ``HOT_SHARE`` such blocks, and a sketch that follows ``TRACKED`` keys finds every one of them.
HOT_SHARE = 1024
HOT_FROM = 10_000
PIECES = 256
TRACKED = 16 * HOT_SHARE


def with_pieces(points: DataFrame, entity: str, ts: str) -> DataFrame:
    """Add ``_piece``: 0 in ordinary blocks, the place among the quantiles of its instants in a hot one.

    Hot (entity, ``_block``) are found by a frequent-items sketch and their quantiles by mergeable summaries, so neither
    moves instants. What is broadcast has at most ``HOT_SHARE`` rows of ``PIECES`` numbers. Which blocks are cut
    changes the work only: pieces are in order, and the chain carries its state over them as over blocks.
    """
    key, at = F.xxhash64(entity, "_block"), micros(ts)
    found = points.agg(
        F.count(F.lit(1)).alias("n"),
        F.call_function("approx_top_k", key, F.lit(HOT_SHARE), F.lit(TRACKED)).alias("top"),
    )
    often = F.filter("top", lambda x: (x["count"] >= HOT_FROM) & (x["count"] * HOT_SHARE > F.col("n")))
    hot = found.select(F.transform(often, lambda x: x["item"]).alias("hot")).scalar()
    probs = [i / PIECES for i in range(1, PIECES)]
    cuts = points.filter(F.array_contains(hot, key)).groupBy(entity, "_block").agg(
        F.percentile_approx(at, probs, 20 * PIECES).alias("_cuts"))
    place = F.coalesce(F.size(F.filter("_cuts", lambda c: c < at)), F.lit(0))
    return points.join(F.broadcast(cuts), [entity, "_block"], "left").withColumn(
        "_piece", F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(place)).drop("_cuts")


def event_chain(df: DataFrame, entity: str, ts: str, block: str = "day") -> DataFrame:
    """One row per (entity, instant): events at it, events up to and with it, neighbouring instants.

    Columns: entity, ts, ``n``, ``seq`` (ordinal of the last event at the instant), ``prev_ts``, ``next_ts``.
    """
    points = (
        df.filter(F.col(entity).isNotNull() & F.col(ts).isNotNull())
        .groupBy(entity, ts)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("_block", F.date_trunc(block, F.col(ts)))
    )
    points = with_pieces(points, entity, ts)
    cut = [entity, "_block", "_piece"]
    inside = Window.partitionBy(*cut).orderBy(ts)
    local = points.select(
        *cut, ts, "n",
        F.lag(ts).over(inside).alias("_prev"),
        F.lead(ts).over(inside).alias("_next"),
        F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("_seq"),
    )
    blocks = points.groupBy(*cut).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.sum("n").alias("_n"))
    across = Window.partitionBy(entity).orderBy("_block", "_piece")
    carry = blocks.select(
        *cut,
        F.lag("_last").over(across).alias("_prev_last"),
        F.lead("_first").over(across).alias("_next_first"),
        F.coalesce(F.sum("_n").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
    )
    return local.join(carry, cut).select(
        entity, ts, "n",
        (F.col("_seq") + F.col("_before")).alias("seq"),
        F.coalesce("_prev", "_prev_last").alias("prev_ts"),
        F.coalesce("_next", "_next_first").alias("next_ts"),
    )


def gaps(df: DataFrame, entity: str, ts: str, block: str = "day") -> DataFrame:
    """Days since the previous event of the entity, by instant; ``n - 1`` further gaps at it are 0."""
    chain = event_chain(df, entity, ts, block)
    return chain.select(entity, ts, "n", "prev_ts", elapsed_days("prev_ts", ts).alias("gap_days"))


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key under a total order, by aggregation: copies of a hot key meet map-side."""
    rest = [c for c in df.columns if c not in keys]
    if set(rest) <= set(order):
        best = F.min(F.struct(*[c for c in order if c not in keys]))  # the order is the row
    else:
        best = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def _bounds(df: DataFrame, columns: Sequence[str], blocks: int) -> list[list[float]]:
    probs = [i / blocks for i in range(1, blocks)]
    found = df.approxQuantile(list(columns), probs, 1.0 / (2 * blocks)) if probs else [[] for _ in columns]
    return [sorted(set(b)) for b in found]


def default_blocks(df: DataFrame) -> int:
    """Twice the shuffle partitions, within [64, 4096]: block totals stay small enough to broadcast."""
    return min(4096, max(64, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def with_blocks(df: DataFrame, columns: Sequence[str], out: Sequence[str], blocks: int | None = None) -> DataFrame:
    """Add the order-preserving block number of each numeric column (one approximate-quantile pass)."""
    blocks = blocks or default_blocks(df)
    found = _bounds(df, columns, blocks)
    inf = float("inf")
    splits = [[-inf, *b, inf] if len(b) > 0 else [-inf, 0.0, inf] for b in found]
    bucketizer = Bucketizer(splitsArray=splits, inputCols=list(columns), outputCols=list(out), handleInvalid="keep")
    return bucketizer.transform(df).withColumns({m: F.col(m).cast("int") for m in out})


def cumulative(
    df: DataFrame,
    value: str,
    measures: Mapping[str, Column] | None = None,
    by: Sequence[str] = (),
    blocks: int | None = None,
    block_column: str | None = None,
) -> DataFrame:
    """Distinct values in ascending order with, for every measure m: ``m``, ``m_before`` and ``m_total``.

    ``m`` is its sum at the value, ``m_before`` over all smaller values of the group and ``m_total``
    over the group. ``measures`` maps names to aggregate columns that add up, ``n`` counts rows.
    """
    measures = dict(measures or {"n": F.count(F.lit(1))})
    by = list(by)
    rows = df.filter(F.col(value).isNotNull())
    if block_column is None:
        rows = with_blocks(rows.withColumn("_position", F.col(value).cast("double")), ["_position"], ["_block"], blocks)
        block_column = "_block"
    # Stated here so that both readers below share one shuffle of the counts.
    for c in (*by, block_column):
        rows = rows.filter(F.col(c).isNotNull())
    freq = rows.groupBy(*by, block_column, value).agg(*[m.alias(k) for k, m in measures.items()])
    inside = Window.partitionBy(*by, block_column).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    local = freq.select(*by, block_column, value, *measures,
                        *[(F.sum(k).over(inside) - F.col(k)).alias(f"_{k}_in") for k in measures])
    totals = freq.groupBy(*by, block_column).agg(*[F.sum(k).alias(f"_{k}_sum") for k in measures])
    across = Window.partitionBy(*(by or [F.lit(0)]))
    before = across.orderBy(block_column).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        *by, block_column,
        *[F.coalesce(F.sum(f"_{k}_sum").over(before), F.lit(0)).alias(f"_{k}_carry") for k in measures],
        *[F.sum(f"_{k}_sum").over(across).alias(f"{k}_total") for k in measures],
    )
    if not by:
        carry = F.broadcast(carry)  # at most one row per block, and the blocks are capped
    joined = local.join(carry, [*by, block_column])
    columns = []
    for k in measures:
        columns += [F.col(k), (F.col(f"_{k}_in") + F.col(f"_{k}_carry")).alias(f"{k}_before"), F.col(f"{k}_total")]
    return joined.select(*by, value, *columns)


def rank_table(df: DataFrame, value: str, by: Sequence[str] = (), blocks: int | None = None) -> DataFrame:
    """Per distinct value: ``pct_rank`` (ties averaged, 0 to 1) and ``rank_desc`` (ties share the best rank)."""
    c = cumulative(df, value, by=by, blocks=blocks)
    return c.select(
        *by, value,
        ((F.col("n_before") + (F.col("n") + 1) / F.lit(2.0)) / F.col("n_total")).alias("pct_rank"),
        (F.col("n_total") - F.col("n_before") - F.col("n") + 1).alias("rank_desc"),
    )


def with_ranks(df: DataFrame, value: str, pct: str | None = "pct_rank", priority: str | None = None,
               by: Sequence[str] = ()) -> DataFrame:
    """Attach percentile rank times 100 and/or descending rank; missing values get no rank."""
    ranks = rank_table(df, value, by)
    keep = [*by, value]
    if pct:
        keep.append((F.col("pct_rank") * 100.0).alias(pct))
    if priority:
        keep.append(F.col("rank_desc").alias(priority))
    ordered = [*df.columns, *[p for p in (pct, priority) if p]]
    return df.join(ranks.select(*keep), [*by, value], "left").select(*ordered)


def ecdf(df: DataFrame, value: str) -> DataFrame:
    c = cumulative(df, value)
    share = (F.col("n_before") + F.col("n")) / F.col("n_total")
    return c.select(value, "n", (F.col("n_before") + F.col("n")).alias("cum_n"), (share * 100.0).alias("cum_pct"))


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Mapping[str, float],
    by: Sequence[str] = (),
    blocks: int | None = None,
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per (group, column).

    Block totals tell which blocks hold the two order statistics around each quantile; only their rows
    are shuffled and ordered. The size of a group or its number of distinct values never has to fit
    one task.
    """
    keys = [*by, "column"]
    prepared = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    marks = [f"_b{i}" for i in range(len(columns))]
    blocked = with_blocks(prepared, columns, marks, blocks)
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("value"), F.col(m).alias("_block"))
             for c, m in zip(columns, marks)]
    long = blocked.select(*by, F.inline(F.array(*pairs))).filter(F.col("value").isNotNull() & ~F.isnan("value"))

    positions = []
    for q in probs.values():
        h = F.lit(float(q)) * (F.col("_total") - 1)
        positions += [F.floor(h), F.ceil(h)]
    group = Window.partitionBy(*keys)
    before = group.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = long.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_n")).select(
        *keys, "_block", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(group).alias("_total"))
    held = F.lit(False)
    for position in positions:
        held = held | ((F.col("_before") <= position) & (position < F.col("_before") + F.col("_n")))
    wanted = totals.filter(held).select(*keys, "_block", "_before", "_total")
    if not by:
        wanted = F.broadcast(wanted)  # at most two blocks per quantile and column
    inside = Window.partitionBy(*keys, "_block").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    near = long.join(wanted, [*keys, "_block"]).groupBy(*keys, "_block", "value").agg(
        F.count(F.lit(1)).alias("n"), F.max("_before").alias("_before"), F.max("_total").alias("_total")).select(
        *keys, "value", "_total", "n", (F.sum("n").over(inside) - F.col("n") + F.col("_before")).alias("n_before"))
    picks = []
    for i, (name, q) in enumerate(probs.items()):
        h = F.lit(float(q)) * (F.col("_total") - 1)
        for tag, position in zip(("lo", "hi"), positions[2 * i:2 * i + 2]):
            at = (F.col("n_before") <= position) & (position < F.col("n_before") + F.col("n"))
            picks.append(F.max(F.when(at, F.col("value"))).alias(f"_{name}_{tag}"))
        picks.append(F.max(h - F.floor(h)).alias(f"_{name}_w"))
    wide = near.groupBy(*keys).agg(*picks)
    out = [(F.col(f"_{n}_lo") + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * F.col(f"_{n}_w")).alias(n) for n in probs]
    return wide.select(*keys, *out)


def quantile_value(df: DataFrame, column: str, q: float) -> Column:
    """One quantile of the whole table as a scalar, usable inside filters and projections."""
    return quantiles(df, [column], {"value": q}).select("value").scalar()


def cap_at_quantile(df: DataFrame, column: str, q: float) -> DataFrame:
    return df.filter(F.col(column) <= quantile_value(df, column, q))


def top_k(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def top_k_per(df: DataFrame, by: Sequence[str], score: str, tiebreak: str, k: int) -> DataFrame:
    """The k highest scores of each group; every task keeps k rows of a group before the shuffle.

    The window group limit of the physical plan does the pre-selection, so a hot group sends at most
    k rows per task.
    """
    w = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(tiebreak).asc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


def best_by(df: DataFrame, by: Sequence[str], metric: str, largest: bool = True) -> DataFrame:
    """The row with the best metric of each group. An undefined metric (NaN, null) never beats a number; of equal
    rows the first by the other columns, in their order, wins."""
    rest = [c for c in df.columns if c not in by]
    value = F.col(metric).cast("double")
    value = F.when(~F.isnan(value), -value if largest else value)
    order = F.struct(value.isNull(), value, *rest)
    return df.groupBy(*by).agg(F.min_by(F.struct(*rest), order).alias("_row")).select(*by, "_row.*").select(*df.columns)
