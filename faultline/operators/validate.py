"""Checks of a table as result rows: (check, status, value), each set from one pass over the table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from faultline import config
from faultline.functions.dates import moment
from faultline.operators.sets import union_all


@dataclass(frozen=True)
class TableRules:
    min_rows: int | None = None
    max_rows: int | None = None
    min_columns: int | None = None
    max_columns: int | None = None
    required: Sequence[str] = ()
    id_column: str | None = None
    no_leakage: bool = False


def _rows(one: DataFrame, checks: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    items = [F.struct(F.lit(n).alias("check"), F.when(F.coalesce(ok, F.lit(False)), F.lit("pass")).otherwise(F.lit("fail")).alias("status"),
                      v.cast("double").alias("value")) for n, ok, v in checks]
    return one.select(F.inline(F.array(*items)))


def validate(df: DataFrame, rules: TableRules) -> DataFrame:
    """Row and column bounds, required columns, key columns without missing values, no leaking names."""
    present = [c for c in rules.required if c in df.columns]
    keys = [c for c in present if c != rules.id_column]
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_k{i}") for i, c in enumerate(keys)])
    checks = []
    if rules.min_rows is not None:
        checks.append(("min_rows", F.col("_n") >= rules.min_rows, F.col("_n")))
    if rules.max_rows is not None:
        checks.append(("max_rows", F.col("_n") <= rules.max_rows, F.col("_n")))
    width = F.lit(len(df.columns))
    if rules.min_columns is not None:
        checks.append(("min_columns", width >= rules.min_columns, width))
    if rules.max_columns is not None:
        checks.append(("max_columns", width <= rules.max_columns, width))
    for c in rules.required:
        checks.append((f"has {c}", F.lit(c in df.columns), F.lit(int(c in df.columns))))
    for i, c in enumerate(keys):
        checks.append((f"no nulls in {c}", F.col(f"_k{i}") == 0, F.col(f"_k{i}")))
    if rules.no_leakage:
        bad = [c for c in df.columns if any(f.lower() in c.lower() for f in config.OUTPUT_LEAKAGE_FRAGMENTS)]
        checks.append(("no leaking names", F.lit(not bad), F.lit(len(bad))))
    return _rows(one, checks)


def validate_all(tables: Mapping[str, tuple[DataFrame, TableRules]]) -> DataFrame:
    return union_all([validate(df, r).select(F.lit(name).alias("table"), "*") for name, (df, r) in tables.items()])


def integrity_checks(assets: DataFrame) -> DataFrame:
    """Violations in the asset table: ages, nested window counts, measures that need two events, signs."""
    c = F.col
    have = set(assets.columns)
    violations = {
        "negative age": (("age_years",), c("age_years") < 0 if "age_years" in have else None),
        "3m above 6m": (("events_3m", "events_6m"), c("events_3m") > c("events_6m")),
        "6m above 12m": (("events_6m", "events_12m"), c("events_6m") > c("events_12m")),
        "first failure after age": (("years_to_first", "age_years"), c("years_to_first") > c("age_years")),
        "mtbf with one event": (("mtbf_days", "n_events"), c("mtbf_days").isNotNull() & (c("n_events") < 2)),
        "recurrence with one event": (("recurs_90d", "n_events"), (c("recurs_90d") == 1) & (c("n_events") < 2)),
        "negative mtbf": (("mtbf_days",), c("mtbf_days") < 0),
        "negative lifetime mtbf": (("mtbf_lifetime_days",), c("mtbf_lifetime_days") < 0),
        "negative observable mtbf": (("mtbf_observable_days",), c("mtbf_observable_days") < 0),
        "negative repair time": (("repair_hours_mean",), c("repair_hours_mean") < 0),
    }
    usable = {k: v for k, (cols, v) in violations.items() if all(x in have for x in cols)}
    one = assets.agg(*[F.count_if(v).alias(f"_v{i}") for i, v in enumerate(usable.values())])
    return _rows(one, [(k, F.col(f"_v{i}") == 0, F.col(f"_v{i}")) for i, k in enumerate(usable)])


def post_cutoff_rows(training: DataFrame, ts: str, cutoff: str) -> DataFrame:
    one = training.agg(F.count_if(F.col(ts) > moment(cutoff)).alias("_n"))
    return _rows(one, [("rows after the cutoff", F.col("_n") == 0, F.col("_n"))])


def temporal_audit(assets: DataFrame, entity: str, install: str, first: str, last: str, cutoff: str,
                   age_a: str, age_b: str, tolerance_years: float = 1.0) -> DataFrame:
    """Failure before installation, last training failure after the cutoff, ages that disagree."""
    one = assets.agg(
        F.count_if(F.col(first) < F.col(install)).alias("_a"),
        F.count_if(F.col(last) > moment(cutoff)).alias("_b"),
        F.count_if(F.abs(F.col(age_a) - F.col(age_b)) > tolerance_years).alias("_c"))
    return _rows(one, [("failure before installation", F.col("_a") == 0, F.col("_a")),
                       ("last failure after the cutoff", F.col("_b") == 0, F.col("_b")),
                       ("ages disagree", F.col("_c") == 0, F.col("_c"))])


def diagnose(assets: DataFrame, entity: str, count: str, audit: DataFrame, max_assets: int, min_match: float = 95.0) -> DataFrame:
    """Problem rows: too many assets, assets without events, duplicate ids, low id match."""
    per_id = assets.groupBy(entity).agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col(count) == 0).alias("_zero"))
    one = per_id.agg(F.sum("_n").alias("_rows"), F.sum("_zero").alias("_zero"), F.sum(F.col("_n") - 1).alias("_dup"))
    rows = _rows(one, [("asset count", F.col("_rows") <= max_assets, F.col("_rows")),
                       ("assets without events", F.col("_zero") == 0, F.col("_zero")),
                       ("duplicate ids", F.col("_dup") == 0, F.col("_dup"))])
    match = _rows(audit, [("id match", F.col("match_pct") >= min_match, F.round("match_pct", 6))])
    return rows.unionByName(match)
