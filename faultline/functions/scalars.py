"""Row-wise expressions: binning, ratios, categories and guarded reliability measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from faultline import config
from faultline.functions.dates import col


def _or_false(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def flag(condition: Column) -> Column:
    """0/1, where an unknown condition counts as 0."""
    return _or_false(condition).cast("int")


def to_number(c: Column | str) -> Column:
    return col(c).cast("string").try_cast("double")


def ratio_plus1(parts: Sequence[Column | str], total: Column | str) -> Column:
    """Share of ``parts`` in ``total + 1``, missing counted as 0, clipped to [0, 1]."""
    numerator = sum((F.coalesce(col(p).cast("double"), F.lit(0.0)) for p in parts), F.lit(0.0))
    share = F.try_divide(numerator, F.coalesce(col(total).cast("double"), F.lit(0.0)) + 1.0)
    return F.when(share.isNotNull(), F.greatest(F.least(share, F.lit(1.0)), F.lit(0.0)))


def ratio_plus1_of_means(parts: Sequence[Column | str], total: Column | str) -> Column:
    """The asset-level fallback: a missing total stays missing and only the upper end is clipped."""
    numerator = sum((F.coalesce(col(p).cast("double"), F.lit(0.0)) for p in parts), F.lit(0.0))
    share = F.try_divide(numerator, col(total).cast("double") + 1.0)
    return F.when(share.isNotNull(), F.least(share, F.lit(1.0)))


def extract_class(c: Column | str, suffixes: Sequence[str] = config.CLASS_SUFFIXES) -> Column:
    """Class name from free text: the first suffix that occurs is removed."""
    text = F.trim(col(c))
    out = None
    for s in suffixes:
        stripped = F.trim(F.replace(text, F.lit(s), F.lit("")))
        out = F.when(text.contains(s), stripped) if out is None else out.when(text.contains(s), stripped)
    return out.otherwise(text)


def harmonize(c: Column | str, mapping: Mapping[str, str] = config.CLASS_NAMES) -> Column:
    """Look a value up in a short dictionary, unknown values stay as they are."""
    return F.coalesce(lookup(c, mapping), col(c))


def lookup(c: Column | str, mapping: Mapping[str, object]) -> Column:
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.create_map(*pairs)[col(c)]


def expected_life(
    c: Column | str,
    exact: Mapping[str, int] = config.EXPECTED_LIFE,
    by_text: Mapping[str, int] = config.EXPECTED_LIFE_BY_VOLTAGE,
    default: int = config.DEFAULT_LIFE,
) -> Column:
    text = F.trim(col(c))
    out = F.when(text.isNull(), F.lit(default)).when(text.isin(*exact), lookup(text, exact))
    for fragment, life in by_text.items():
        out = out.when(text.contains(fragment), F.lit(life))
    return out.otherwise(F.lit(default))


def age_ratio(age: Column | str, life: Column | str) -> Column:
    return F.when(col(age).isNotNull() & (col(life) > 0), col(age) / col(life))


def cut(c: Column | str, edges: Sequence[float], labels: Sequence[str], include_lowest: bool = False) -> Column:
    """Right-closed bins; a value outside them, or on the lowest edge, has no label."""
    value = col(c).cast("double")
    out = None
    for i, label in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        above = value >= lo if (i == 0 and include_lowest) else value > lo
        inside = above if hi == float("inf") else above & (value <= hi)
        inside = inside & ~F.isnan(value)
        out = F.when(inside, F.lit(label)) if out is None else out.when(inside, F.lit(label))
    return out


def cut_index(c: Column | str, edges: Sequence[float], include_lowest: bool = False) -> Column:
    """Position of the bin, for ordering labels."""
    return cut(c, edges, [str(i) for i in range(len(edges) - 1)], include_lowest).cast("int")


def threshold_class(c: Column | str, cuts: Sequence[tuple[float, str]] = config.SURVIVAL_CUTS,
                    otherwise: str = config.SURVIVAL_FLOOR) -> Column:
    out = None
    for limit, label in cuts:
        out = F.when(col(c) >= limit, F.lit(label)) if out is None else out.when(col(c) >= limit, F.lit(label))
    return out.otherwise(F.lit(otherwise))


def horizon_class(c: Column | str, threshold: float) -> Column:
    return flag(col(c) >= threshold)


def reliability_score(mtbf: Column | str) -> Column:
    return F.when(col(mtbf) > 0, F.least(F.lit(100.0), col(mtbf) / 365.0 * 100.0)).otherwise(F.lit(0.0))


def time_since_last_normalized(days: Column | str, mtbf: Column | str) -> Column:
    return F.when(col(mtbf) > 0, col(days) / col(mtbf))


def overdue_factor(days: Column | str, mtbf: Column | str, n: Column | str) -> Column:
    return F.when((col(mtbf) > 0) & ~_or_false(col(n) == 0), col(days) / col(mtbf))


def overdue_band(factor: Column | str) -> Column:
    f = col(factor)
    return F.when(f < 0.8, F.lit("not due")).when(f < 1.2, F.lit("approaching")).when(f >= 1.2, F.lit("overdue"))


def failure_free(n: Column | str) -> Column:
    return flag(col(n) == 0)


def mtbf_trend(days_since: Column | str, mtbf: Column | str, n: Column | str) -> Column:
    usable = col(mtbf).isNotNull() & ~_or_false(col(n) < 4)
    return F.when(
        usable,
        F.when(col(days_since).isNotNull() & (col(mtbf) > 0), col(days_since) / col(mtbf)).otherwise(F.lit(1.0)),
    )


def trend_band(trend: Column | str) -> Column:
    t = col(trend)
    return F.when(t < 0.8, F.lit("degrading")).when(t <= 1.2, F.lit("stable")).when(t > 1.2, F.lit("improving"))


def mtbf_variability(lifetime: Column | str, observable: Column | str, n: Column | str) -> Column:
    known = col(lifetime).isNotNull() & col(observable).isNotNull() & (col(observable) > 0)
    return F.when(
        ~_or_false(col(n) < 2),
        F.when(known, F.abs(col(lifetime) - col(observable)) / col(observable)).otherwise(F.lit(0.0)),
    )


def variability_band(v: Column | str) -> Column:
    x = col(v)
    return F.when(x < 0.3, F.lit("predictable")).when(x <= 0.7, F.lit("moderate")).when(x > 0.7, F.lit("erratic"))


def customer_minutes(customers: Column | str, faults: Column | str, minutes: float = 120.0) -> Column:
    return col(customers) * col(faults) * F.lit(minutes)


def voltage_class(volts: Column | str) -> Column:
    v = col(volts).cast("double")
    return (
        F.when(v.isNull(), F.lit(None).cast("string"))
        .when(v < 1000, F.lit("AG"))
        .when((v >= 10000) & (v < 36000), F.lit("OG"))
        .when(v >= 36000, F.lit("YG"))
        .otherwise(F.lit("Bilinmeyen"))
    )


def voltage_flags(voltage: Column | str) -> dict[str, Column]:
    return {
        "is_mv": flag(col(voltage) == "OG"),
        "is_lv": flag(col(voltage) == "AG"),
        "is_hv": flag(col(voltage) == "YG"),
    }


def region_type(district: Column | str, urban: Sequence[str] = config.URBAN_DISTRICTS,
                names: tuple[str, str] = ("Kentsel", "Kırsal")) -> Column:
    return F.when(_or_false(F.upper(col(district)).isin(*urban)), F.lit(names[0])).otherwise(F.lit(names[1]))


def loading_score(days_since: Column | str) -> Column:
    days = F.greatest(F.coalesce(col(days_since).cast("double"), F.lit(365.0)), F.lit(0.0))
    return F.lit(1.0) / (days + 1.0)


def null_text(c: Column | str) -> Column:
    """The text a missing value takes in combined keys and label encodings."""
    return F.coalesce(col(c).cast("string"), F.lit("nan"))


def combine(a: Column | str, b: Column | str) -> Column:
    return F.concat_ws("_", null_text(a), null_text(b))


def cause_flags(consistency: Column | str, diversity: Column | str, first: Column | str,
                last: Column | str) -> dict[str, Column]:
    return {
        "single_cause_flag": flag(col(consistency) >= 0.8),
        "multi_cause_flag": flag(col(diversity) >= 3),
        "cause_changed_flag": (null_text(first) != null_text(last)).cast("int"),
    }


# Keyword groups of asset classes, first match wins, on the upper-cased text.
CLASS_GROUPS = (
    ("Switch_Disconnector", ("AYIRICI", "SWITCH")),
    ("Circuit_Breaker", ("ANAHTAR", "BREAKER")),
    ("Transformer", ("TRAFO", "TRANSFORMER")),
    ("Recloser", ("KESICI", "RECLOSER")),
    ("Fuse", ("SIGORTA", "FUSE")),
    ("Line_Equipment", ("HAT", "LINE")),
)


def class_group(c: Column | str, rules: Sequence[tuple[str, Sequence[str]]] = CLASS_GROUPS) -> Column:
    """Keyword group of a class, null where no keyword occurs."""
    text = F.upper(col(c))
    out = F.when(text.isNull(), F.lit("Unknown"))
    for name, words in rules:
        hit = text.contains(words[0])
        for w in words[1:]:
            hit = hit | text.contains(w)
        out = out.when(hit, F.lit(name))
    return out


def recommended_action(category: Column | str, actions: Mapping[str, str] = config.ACTIONS) -> Column:
    return lookup(category, actions)


def finite(c: Column | str) -> Column:
    """Infinite and not-a-number values become null."""
    x = col(c).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def quality_rating(score: Column | str) -> Column:
    s = col(score)
    return (
        F.when(s >= 9, F.lit("EXCELLENT")).when(s >= 7, F.lit("GOOD")).when(s >= 5, F.lit("FAIR"))
        .otherwise(F.lit("POOR"))
    )


def coverage_band(pct: Column | str) -> Column:
    p = col(pct)
    return F.when(p > 90, F.lit("high")).when(p > 70, F.lit("medium")).otherwise(F.lit("low"))


def missing_band(pct: Column | str) -> Column:
    p = col(pct)
    return F.when(p > 50, F.lit("critical")).when(p > 20, F.lit("high")).when(p > 5, F.lit("medium")).otherwise(
        F.lit("low"))


def risk_score(probability: Column | str, digits: int = 2) -> Column:
    """Probability as a score of 0 to 100."""
    score = F.round(col(probability) * 100.0, digits)
    return F.when(score.isNotNull(), F.greatest(F.least(score, F.lit(100.0)), F.lit(0.0)))


def coalesce_id(ids: Sequence[Column | str]) -> Column:
    return F.coalesce(*[col(c) for c in ids])


def row_mean(cols: Sequence[Column | str]) -> Column:
    """Mean over the columns of a row, missing values left out."""
    total = sum((F.coalesce(col(c).cast("double"), F.lit(0.0)) for c in cols), F.lit(0.0))
    known = sum((col(c).isNotNull().cast("int") for c in cols), F.lit(0))
    return F.try_divide(total, known)


def row_sum(cols: Sequence[Column | str]) -> Column:
    return sum((F.coalesce(col(c).cast("double"), F.lit(0.0)) for c in cols), F.lit(0.0))


def healthy_mask(columns: Sequence[str], history: str = "has_failure_history", source: str = "data_source",
                 total: str = "total_faults", recency: str = "days_since_last") -> Column:
    """Which assets never failed, decided by the first of these columns the table has."""
    if history in columns:
        return _or_false(col(history) == 0)
    if source in columns:
        return _or_false(col(source) == "Healthy_Equipment")
    if total in columns:
        return _or_false(col(total) == 0)
    if recency in columns:
        return col(recency).isNull()
    return F.lit(False)
