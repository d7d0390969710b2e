"""Feature selection: constants, leakage by name, correlation, variance inflation, and the decision report.

Everything that depends on the rows is one pass each of sketches and of pair sums; the eliminations then work on p x p matrices.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from faultline import config
from faultline.operators import moments, profile as P, schema as N, sketches
from faultline.operators.encode import encode
from faultline.session import checkpoint


@dataclass
class SelectionConfig:
    id_column: str
    targets: Sequence[str] = ()
    protected: Sequence[str] = ()
    protect_from_correlation: bool = False
    names: dict[str, str] = field(default_factory=dict)  # translations, used by the protected-name test
    near_constant_share: float = config.NEAR_CONSTANT_SHARE  # of the most frequent value
    near_constant_ratio: float | None = None  # distinct values per row; its verdict depends on the number of rows
    near_constant_variance: float = config.NEAR_CONSTANT_VARIANCE
    correlation_limit: float = config.CORRELATION_LIMIT
    vif_target: float = config.VIF_TARGET


@dataclass
class Decision:
    feature: str
    status: str = "RETAINED"
    reason: str | None = None
    phase: int | None = None


def _features(df: DataFrame, cfg: SelectionConfig) -> list[str]:
    return [c for c in df.columns if c != cfg.id_column and c not in cfg.targets]


def _protected(cfg: SelectionConfig) -> Callable[[str], bool]:
    return lambda c: N.is_protected(c, cfg.protected, cfg.names)


def column_stats(df: DataFrame, columns: Sequence[str]) -> dict[str, dict]:
    """Distinct values, rows, filled rows, rows of the most frequent value and variance per column, by sketches."""
    report = sketches.report(sketches.sketch(df, columns))
    stats = {r["column"]: {"distinct": r["n_distinct"], "rows": r["n_rows"], "filled": r["non_null"], "most": r["n_most"]}
             for r in report.collect()}  # one row per column
    numeric = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]
    if numeric:
        one = df.agg(*[F.var_samp(F.col(f"`{c}`")).alias(f"v{i}") for i, c in enumerate(numeric)]).first()
        for i, c in enumerate(numeric):
            stats[c]["variance"] = one[f"v{i}"]
    return stats


def find_constant(stats: dict[str, dict], protected: Callable[[str], bool]) -> list[Decision]:
    return [Decision(c, "REMOVED_CONSTANT", f"holds {s['distinct']} distinct value(s), at least 2 wanted", 1)
            for c, s in stats.items() if s["distinct"] <= 1 and not protected(c)]


def find_near_constant(stats: dict[str, dict], cfg: SelectionConfig, protected: Callable[[str], bool]) -> list[Decision]:
    """Low variance, or one value that nearly all filled rows share; both are the same on any number of copies."""
    out = []
    for c, s in stats.items():
        if s["distinct"] <= 1 or protected(c) or s.get("variance") is None:
            continue
        low = s["variance"] < cfg.near_constant_variance
        share = s["most"] / s["filled"]
        few = cfg.near_constant_ratio is not None and s["distinct"] / s["rows"] < cfg.near_constant_ratio
        if low or share > cfg.near_constant_share or few:
            measured = f"variance {s['variance']:.6g} (least {cfg.near_constant_variance:g}), top value {share:.2%} (most {cfg.near_constant_share:.0%})"
            out.append(Decision(c, "REMOVED_NEAR_CONSTANT", measured, 1))
    return out


def find_leaky(columns: Sequence[str], protected: Callable[[str], bool]) -> list[Decision]:
    return [Decision(c, "REMOVED_LEAKAGE", f"name tells the outcome ({kind})", 2)
            for c, kind in N.leaky_names(columns).items() if not protected(c)]


def find_correlated(df: DataFrame, columns: Sequence[str], stats: dict[str, dict], limit: float,
                    protected: Callable[[str], bool] = lambda c: False) -> list[Decision]:
    """Of every pair above the limit the less covered column goes, on a tie the later one."""
    if len(columns) < 2:
        return []
    pairs = {(r["feature_1"], r["feature_2"]): r["r"] for r in P.correlated_pairs(df, columns, limit).collect()}
    out: dict[str, Decision] = {}
    for i, a in enumerate(columns):
        for b in columns[i + 1:]:
            r = pairs.get((a, b))
            if r is None:
                continue
            drop, keep = (b, a) if stats[a]["filled"] >= stats[b]["filled"] else (a, b)
            if drop not in out and not protected(drop):
                out[drop] = Decision(drop, "REMOVED_HIGH_CORRELATION", f"|r| to {keep} is {abs(r):.3f}, most {limit:g}", 3)
    return list(out.values())


def vif_of(g: np.ndarray) -> np.ndarray:
    """Uncentred variance inflation of every column; infinite where it is a combination of the others."""
    d = np.sqrt(np.diag(g))
    d[d == 0] = 1.0
    m = g / np.outer(d, d)
    values, vectors = np.linalg.eigh(m)
    good = values > 1e-10 * max(values.max(), 1e-300)
    out = (vectors[:, good] ** 2 / values[good]).sum(axis=1)
    out[(np.abs(vectors[:, ~good]) > 1e-6).any(axis=1)] = np.inf
    return out


def vif_table(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    return dict(zip(columns, vif_of(moments.gram(df, columns))))


def vif_select(df: DataFrame, columns: Sequence[str], cfg: SelectionConfig) -> tuple[list[str], list[Decision]]:
    """Drop the largest inflation until it is at most the target (or 15 with at most 20 columns)."""
    numeric = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]
    text = [c for c in columns if c not in numeric]
    if len(numeric) < 2:
        return list(columns), []
    rows = encode(df, text).select(*[F.col(f"`{c}`").cast("double").alias(c) for c in numeric],
                                   *[F.col(f"`{c}_code`").alias(c) for c in text])
    rows = P.impute(checkpoint(rows), median=[*numeric, *text])
    kept, g = [*numeric, *text], moments.gram(rows, [*numeric, *text])
    removed = []
    while len(kept) > 1:
        v = vif_of(g)
        worst = int(np.argmax(v))
        if v[worst] <= cfg.vif_target or (v[worst] <= 15 and len(kept) <= 20):
            break
        removed.append(Decision(kept[worst], "REMOVED_HIGH_VIF", f"variance inflation {v[worst]:.1f}, most {cfg.vif_target:g}", 4))
        kept.pop(worst)
        g = np.delete(np.delete(g, worst, 0), worst, 1)
    return kept, removed


def select_features(df: DataFrame, cfg: SelectionConfig) -> tuple[DataFrame, list[Decision]]:
    """All phases in order; returns the reduced table and one decision per column.

    Give it a stored table (the feature table of the step before): every phase reads it.
    """
    protected = _protected(cfg)
    left = _features(df, cfg)
    stats = column_stats(df, left)
    removed: list[Decision] = []

    def apply(found: list[Decision]) -> None:
        nonlocal left
        gone = {d.feature for d in found}
        removed.extend(d for d in found if d.feature in left)
        left = [c for c in left if c not in gone]

    apply(find_constant(stats, protected))
    apply(find_near_constant({c: stats[c] for c in left}, cfg, protected))
    apply(find_leaky(left, protected))
    numeric = [c for c in left if isinstance(df.schema[c].dataType, T.NumericType)]
    apply(find_correlated(df, numeric, stats, cfg.correlation_limit,
                          protected if cfg.protect_from_correlation else lambda c: False))
    _, inflated = vif_select(df, left, cfg)
    apply(inflated)
    keep = [c for c in (cfg.id_column, *cfg.targets) if c in df.columns] + left
    return df.select(*[F.col(f"`{c}`") for c in keep]), [*removed, *[Decision(c) for c in left]]


def selection_report(spark, decisions: Sequence[Decision]) -> DataFrame:
    rows = [(d.feature, d.status, d.reason, d.phase) for d in decisions]
    df = spark.createDataFrame(rows, "feature string, status string, reason string, phase int")
    return df.withColumn("category", N.category(F.col("feature")))
