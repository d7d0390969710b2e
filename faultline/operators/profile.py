"""Column profiles, value counts, quality scorecards, distributions and correlations as report tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from faultline.functions import scalars as S
from faultline.functions.dates import elapsed_days, moment
from faultline.operators import moments, sketches
from faultline.operators.ordered import quantiles, quantile_value


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]
    return df.select(F.inline(F.array(*pairs)))


def types_table(df: DataFrame) -> Column:
    return F.create_map(*[F.lit(x) for name, t in df.dtypes for x in (name, t)])


def profile(df: DataFrame, distinct: str | None = None) -> DataFrame:
    """One row per column: type, counts, missing share, distinct values if asked for, an example (the smallest text).

    Counts and examples take one aggregate in which no value leaves its partition. ``distinct`` is None, ``"sketch"``
    (``sketches.py``, one pass as well) or ``"exact"``, which counts (column, value) pairs in a shuffle.
    """
    columns = df.columns
    if distinct == "sketch":
        out = sketches.report(sketches.sketch(df))
    elif distinct == "exact":
        counts = _long(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        out = counts.groupBy("column").agg(
            F.sum("n").alias("n_rows"),
            F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("non_null"),
            F.count("value").alias("n_distinct"),
            F.min("value").alias("sample_value"),
        ).withColumn("data_type", types_table(df)[F.col("column")])
    elif distinct is None:
        aggs = [F.count(F.lit(1)).alias("_n")]
        for i, c in enumerate(columns):
            aggs += [F.count(F.col(f"`{c}`")).alias(f"_c{i}"), F.min(F.col(f"`{c}`").cast("string")).alias(f"_s{i}")]
        rows = [F.struct(F.lit(c).alias("column"), F.lit(t).alias("data_type"), F.col("_n").alias("n_rows"), F.col(f"_c{i}").alias("non_null"),
                         F.col(f"_s{i}").alias("sample_value")) for i, (c, t) in enumerate(df.dtypes)]
        out = df.agg(*aggs).select(F.inline(F.array(*rows)))
    else:
        raise ValueError(f"distinct is None, 'sketch' or 'exact', not {distinct!r}")
    nulls = F.col("n_rows") - F.col("non_null")
    return out.select(
        "column", "data_type", "n_rows", "non_null", nulls.alias("n_null"),
        F.round(F.try_divide(nulls, F.col("n_rows")) * 100.0, 2).alias("null_pct"), *(["n_distinct"] if distinct else []), "sample_value")


def value_spread(df: DataFrame) -> DataFrame:
    """Exact distinct values and rows of the most frequent value per column, from counts of (column, value) pairs."""
    counts = _long(df, df.columns).filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"), F.max("n").alias("n_most"))


def missing_bands(report: DataFrame) -> DataFrame:
    return report.filter(F.col("n_null") > 0).select(
        "column", "n_null", "null_pct", S.missing_band("null_pct").alias("band"))


def completeness(report: DataFrame) -> DataFrame:
    """Overall share of filled cells from the column report."""
    return report.agg(((F.lit(1.0) - F.sum("n_null") / F.sum("n_rows")) * 100.0).alias("completeness_pct"))


def recommendations(report: DataFrame, post_cutoff_events: DataFrame, min_events: int, max_text: int) -> DataFrame:
    """Advice rows: columns mostly missing, too few events after the cutoff, many text columns."""
    empty = report.filter(F.col("null_pct") > 50).select(
        F.lit("HIGH").alias("priority"), F.lit("mostly missing").alias("kind"), F.col("column").alias("subject"), F.col("null_pct").alias("measure"))
    few = post_cutoff_events.filter(F.col("n") < min_events).select(
        F.lit("MEDIUM").alias("priority"), F.lit("few events after the cutoff").alias("kind"), F.lit("events").alias("subject"),
        F.col("n").cast("double").alias("measure"))
    text = report.filter(F.col("data_type") == "string").agg(F.count(F.lit(1)).alias("n"))
    many = text.filter(F.col("n") > max_text).select(
        F.lit("MEDIUM").alias("priority"), F.lit("many text columns").alias("kind"), F.lit("columns").alias("subject"),
        F.col("n").cast("double").alias("measure"))
    return empty.unionByName(few).unionByName(many)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts with share, rare (<10 rows) and dominant (>20 %) marks."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("t")).scalar()
    return counts.select(
        F.col(column).alias("value"), "n", (F.col("n") / total * 100.0).alias("pct"),
        (F.col("n") < 10).alias("rare"), (F.col("n") / total > 0.20).alias("dominant"))


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values and one row for all others."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.col("n").desc(), F.col(column)).limit(k).select(F.col(column).alias("value"), "n")
    known = df.agg(F.count(column).alias("t"))
    rest = top.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("s")).select(
        F.lit("Others").alias("value"), (known.scalar() - F.col("s")).alias("n")).filter(F.col("n") > 0)
    return top.unionByName(rest)


def imbalance(df: DataFrame, column: str, head: int = 2) -> DataFrame:
    """Distinct values, share of the most frequent ones, number of rare and dominant ones."""
    counts = value_counts(df, column)
    top = counts.orderBy(F.col("n").desc(), "value").limit(head).agg(F.sum("pct").alias("s"))
    return counts.agg(
        F.count(F.lit(1)).alias("n_values"), F.count_if("rare").alias("n_rare"),
        F.count_if("dominant").alias("n_dominant")).withColumn("top_share_pct", top.scalar())


def coverage(df: DataFrame, columns: Sequence[str], jointly: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Filled share per column, and per set of columns that must be filled together."""
    jointly = jointly or {}
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.count(c).alias(f"_c{i}") for i, c in enumerate(columns)]
    for i, cs in enumerate(jointly.values()):
        present = F.lit(True)
        for c in cs:
            present = present & F.col(c).isNotNull()
        aggs.append(F.count_if(present).alias(f"_j{i}"))
    names = [(c, f"_c{i}") for i, c in enumerate(columns)] + [(c, f"_j{i}") for i, c in enumerate(jointly)]
    rows = [F.struct(F.lit(n).alias("column"), F.col(a).alias("filled"), (F.try_divide(F.col(a), F.col("_n")) * 100.0).alias("pct"))
            for n, a in names]
    return df.agg(*aggs).select(F.inline(F.array(*rows))).withColumn("band", S.coverage_band("pct"))


def temporal_coverage(df: DataFrame, ts: str, cutoff: str) -> DataFrame:
    return df.agg(
        F.min(ts).alias("first"), F.max(ts).alias("last"), F.count(ts).alias("n"),
        F.count_if(F.col(ts) <= moment(cutoff)).alias("n_before"),
        F.count_if(F.col(ts) > moment(cutoff)).alias("n_after"),
    ).withColumn("span_days", elapsed_days("first", "last"))


def events_per_year(df: DataFrame, ts: str) -> DataFrame:
    total = df.agg(F.count(F.lit(1)).alias("t")).scalar()
    return df.filter(F.col(ts).isNotNull()).groupBy(F.year(ts).alias("year")).agg(
        F.count(F.lit(1)).alias("n")).withColumn("pct", F.col("n") / total * 100.0)


def above_quantile(df: DataFrame, column: str, q: float) -> DataFrame:
    """Number of rows above a quantile of their column, with the mean and the limit."""
    limited = df.select(F.col(column).alias("v")).withColumn("limit", quantile_value(df, column, q))
    return limited.agg(F.count_if(F.col("v") > F.col("limit")).alias("n_above"), F.avg("v").alias("mean"),
                       F.max("limit").alias("quantile"))


# The quantiles of a distribution summary, besides its minimum and maximum.
SUMMARY_QUANTILES = {"q25": 0.25, "median": 0.5, "q75": 0.75, "p95": 0.95}


def describe(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, standard deviation and exact quantiles per column (and group)."""
    by = list(by)
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    number = F.when(~F.isnan("value"), F.col("value"))
    plain = df.select(*by, F.inline(F.array(*pairs))).filter(F.col("value").isNotNull()).groupBy(*by, "column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min(number).alias("min"), F.max(number).alias("max"))
    return plain.join(quantiles(df, columns, SUMMARY_QUANTILES, by), [*by, "column"])


def linear_trend(df: DataFrame, x: str, y: str, cap: float | None = None) -> DataFrame:
    """Least-squares line and correlation, after dropping x above its quantile ``cap``."""
    pairs = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    if cap is not None:
        pairs = pairs.filter(F.col("x") <= quantile_value(pairs, "x", cap))
    return pairs.agg(F.count(F.lit(1)).alias("n"), F.regr_slope("y", "x").alias("slope"),
                     F.regr_intercept("y", "x").alias("intercept"), F.corr("x", "y").alias("r"))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete correlation of every column pair, from one scan; null where a side is constant."""
    if len(columns) < 2:
        return df.limit(0).select(F.lit("").alias("feature_1"), F.lit("").alias("feature_2"), F.lit(0.0).alias("r"))
    names = F.array(*[F.lit(c) for c in columns])
    return moments.pair_sums(df, columns).where("i < j").select(
        F.get(names, F.col("i")).alias("feature_1"), F.get(names, F.col("j")).alias("feature_2"), moments.correlation().alias("r"))


def correlated_pairs(df: DataFrame, columns: Sequence[str], limit: float) -> DataFrame:
    return correlations(df, columns).filter(F.abs("r") > limit)


def binned_mean(df: DataFrame, x: str, y: str, bins: int) -> DataFrame:
    """Mean of y over equal-width right-closed bins of x; the lowest value belongs to the first bin."""
    lo = df.agg(F.min(x).cast("double").alias("v")).scalar()
    hi = df.agg(F.max(x).cast("double").alias("v")).scalar()
    placed = df.filter(F.col(x).isNotNull()).select(F.col(x).cast("double").alias("x"), F.col(y).alias("y")).withColumn(
        "step", (hi - lo) / bins).withColumn("lo", lo)
    raw = F.ceil(F.try_divide(F.col("x") - F.col("lo"), F.col("step")))
    index = F.least(F.greatest(F.coalesce(raw, F.lit(1)), F.lit(1)), F.lit(bins)).cast("int")
    return placed.groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean"))


def impute(df: DataFrame, median: Sequence[str] = (), constants: Mapping[str, object] | None = None) -> DataFrame:
    """Missing and non-finite values to the exact column median (0 where there is none), or to a constant."""
    constants = dict(constants or {})
    out = df
    if median:
        cleaned = df.withColumns({c: S.finite(c) for c in median})
        q = quantiles(cleaned, median, {"m": 0.5}).agg(F.map_from_entries(F.collect_list(F.struct("column", "m"))).alias("x"))
        medians = q.scalar()  # one entry per imputed column
        out = cleaned.withColumn("_medians", medians)
        out = out.withColumns({c: F.coalesce(F.col(c), F.try_element_at("_medians", F.lit(c)), F.lit(0.0))
                               for c in median}).drop("_medians")
    for c, v in constants.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def scorecard(df: DataFrame, criteria: Mapping[str, tuple[Column, float, str]]) -> DataFrame:
    """(criterion, value, passed) rows from one aggregate.

    A criterion is (aggregate, limit, comparison), the comparison one of ``>``, ``>=``, ``<``, ``<=``.
    """
    one = df.agg(*[agg.cast("double").alias(f"_v{i}") for i, (agg, _, _) in enumerate(criteria.values())])
    rows = []
    for i, (name, (_, limit, how)) in enumerate(criteria.items()):
        v = F.col(f"_v{i}")
        passed = {">": v > limit, ">=": v >= limit, "<": v < limit, "<=": v <= limit}[how]
        rows.append(F.struct(F.lit(name).alias("criterion"), v.alias("value"),
                             F.coalesce(passed, F.lit(False)).alias("passed")))
    return one.select(F.inline(F.array(*rows)))


def filled_pct(column: str) -> Column:
    return F.try_divide(F.count(column), F.count(F.lit(1))) * 100.0


def quality_scorecard(df: DataFrame, entity: str, asset_class: str, install: str, ts: str, customers: str,
                      coordinates: Sequence[str]) -> DataFrame:
    """The ten-criterion card; duplicates and distinct classes come from their own counted aggregates."""
    both = F.lit(True)
    for c in coordinates:
        both = both & F.col(c).isNotNull()
    filled = sum((F.count(f"`{c}`") for c in df.columns), F.lit(0))
    base = scorecard(df, {
        "id": (filled_pct(entity), 90.0, ">"),
        "class": (filled_pct(asset_class), 80.0, ">"),
        "install date": (filled_pct(install), 80.0, ">"),
        "event time": (filled_pct(ts), 90.0, ">"),
        "customers": (filled_pct(customers), 80.0, ">"),
        "coordinates": (F.try_divide(F.count_if(both), F.count(F.lit(1))) * 100.0, 80.0, ">"),
        "time span": (elapsed_days(F.min(ts), F.max(ts)), 365.0, ">"),
        "completeness": (F.try_divide(filled, F.count(F.lit(1)) * len(df.columns)) * 100.0, 70.0, ">"),
    })
    distinct_rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    unique = scorecard(distinct_rows, {"no duplicates": (F.count(F.lit(1)) / F.sum("n") * 100.0, 95.0, ">")})
    variety = scorecard(df, {"class variety": (F.count_distinct(asset_class), 5.0, ">")})
    return base.unionByName(unique).unionByName(variety)


def optional_criteria(df: DataFrame, criteria: Mapping[str, tuple[Sequence[str], float]]) -> DataFrame:
    """Extra criteria on columns a table may lack: the best filled of the present ones against a limit.

    A criterion none of whose columns is present is left out.
    """
    present = {n: ([c for c in cols if c in df.columns], limit) for n, (cols, limit) in criteria.items()}
    usable = {}
    for name, (cols, limit) in present.items():
        shares = [filled_pct(c) for c in cols]
        if shares:
            usable[name] = (F.greatest(*shares) if len(shares) > 1 else shares[0], limit, ">")
    if not usable:
        return df.limit(0).select(F.lit("").alias("criterion"), F.lit(0.0).alias("value"), F.lit(True).alias("passed"))
    return scorecard(df, usable)


def raw_scorecard(df: DataFrame, key_columns: Sequence[str], min_rows: int = 100) -> DataFrame:
    """First look at an input: no empty column, key columns there, enough rows, no repeated rows."""
    empty = sum(((F.count(f"`{c}`") == 0).cast("int") for c in df.columns), F.lit(0))
    present = F.lit(int(all(c in df.columns for c in key_columns)))
    base = scorecard(df, {
        "no empty columns": (empty, 0.0, "<="), "key columns present": (F.max(present), 1.0, ">="),
        "sufficient rows": (F.count(F.lit(1)), float(min_rows), ">=")})
    distinct_rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    copies = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    return base.unionByName(scorecard(distinct_rows, {"no duplicates": (copies, 0.0, "<=")}))


def rated(card: DataFrame) -> DataFrame:
    return card.agg(F.count_if("passed").alias("score"), F.count(F.lit(1)).alias("of")).withColumn(
        "rating", S.quality_rating("score"))


def rank_rows(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Row numbers on a small report table."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))
