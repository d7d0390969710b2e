"""Column-name operators: checks, renames, categories, leakage by name, vocabulary reports.

They look at the schema only; where a report is asked for, it is joined to the profile of the table.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from faultline import config


def require_columns(df: DataFrame, required: Sequence[str], optional: Sequence[str] = ()) -> list[str]:
    """The optional columns that are absent; raises when a required one is."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return [c for c in optional if c not in df.columns]


def resolve_column(columns: Sequence[str], candidates: Sequence[str], keywords: Sequence[str] = ()) -> str | None:
    """The first candidate present, else the first column whose name holds a keyword."""
    for c in candidates:
        if c in columns:
            return c
    for c in columns:
        if any(k.lower() in c.lower() for k in keywords):
            return c
    return None


def inverse(mapping: Mapping[str, str]) -> dict[str, str]:
    return {v: k for k, v in mapping.items()}


def rename(df: DataFrame, mapping: Mapping[str, str], inverted: bool = False) -> DataFrame:
    names = inverse(mapping) if inverted else mapping
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns and k != v})


def classify_names(columns: Iterable[str], mapping: Mapping[str, str], translated: bool = True) -> dict[str, str]:
    """valid (in the expected vocabulary), invalid (in the other one) or unknown."""
    expected = set(mapping.values()) if translated else set(mapping)
    known = set(mapping) | set(mapping.values())
    return {c: "valid" if c in expected else "invalid" if c in known else "unknown" for c in columns}


def is_protected(name: str, protected: Iterable[str], mapping: Mapping[str, str]) -> bool:
    """Whether a name, or its name in the other language, is on the protected list."""
    shown = {mapping.get(p, p) for p in protected}
    return name in shown or mapping.get(name, name) in shown


def category(name: Column, rules=config.CATEGORY_RULES, default: str = "Other") -> Column:
    out = None
    for label, fragments in rules:
        hit = name.contains(fragments[0])
        for f in fragments[1:]:
            hit = hit | name.contains(f)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(default))


def listed_category(name: Column, lists: Mapping[str, Sequence[str]], default: str = "Other") -> Column:
    """Category by exact membership in named lists."""
    out = None
    for label, names in lists.items():
        hit = name.isin(*names)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(default))


def _holds(name: Column, fragments: Sequence[str]) -> Column:
    hit = F.lit(False)
    for f in fragments:
        hit = hit | name.contains(f.lower())
    return hit


def leakage(name: Column, patterns: Mapping[str, Sequence[str]] = config.LEAKAGE_FRAGMENTS,
            safe: Sequence[str] = config.SAFE_FRAGMENTS) -> Column:
    """Kind of leakage a column name shows, ``safe`` for listed history names, null for neither."""
    text = F.lower(name)
    out = F.when(_holds(text, safe), F.lit("safe"))
    for kind, fragments in patterns.items():
        out = out.when(_holds(text, fragments), F.lit(kind))
    return out


def leaky_names(columns: Sequence[str], patterns: Mapping[str, Sequence[str]] = config.LEAKAGE_FRAGMENTS,
                safe: Sequence[str] = config.SAFE_FRAGMENTS) -> dict[str, str]:
    """The same rule on a list of names, decided without a job."""
    def holds(name: str, fragments: Sequence[str]) -> bool:
        return any(f.lower() in name.lower() for f in fragments)

    found = {}
    for c in columns:
        if holds(c, safe):
            continue
        kind = next((k for k, fragments in patterns.items() if holds(c, fragments)), None)
        if kind is not None:
            found[c] = kind
    return found


def column_reference(report: DataFrame, mapping: Mapping[str, str], rules=config.CATEGORY_RULES) -> DataFrame:
    """Name, translation, category, type and coverage of every column of a profiled table."""
    names = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return report.select(
        "column", F.coalesce(names[F.col("column")], F.col("column")).alias("translation"),
        category(F.col("column"), rules).alias("category"), "data_type", "non_null",
        F.round(F.col("non_null") / F.col("n_rows") * 100.0, 1).alias("coverage_pct"))


def annotate_importance(importance: DataFrame, mapping: Mapping[str, str], rules=config.CATEGORY_RULES) -> DataFrame:
    names = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return importance.withColumns({
        "display_name": F.coalesce(names[F.col("feature")], F.col("feature")),
        "category": category(F.col("feature"), rules)})


def columns_by_type(df: DataFrame, known_categorical: Sequence[str] = (),
                    date_words: Sequence[str] = ("date", "tarih")) -> dict[str, list[str]]:
    """Numeric, categorical and date-like columns, from the schema alone."""
    out: dict[str, list[str]] = {"numeric": [], "categorical": [], "date": []}
    for f in df.schema.fields:
        dated = isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))
        if dated or any(w in f.name.lower() for w in date_words):
            out["date"].append(f.name)
        elif f.name in known_categorical or isinstance(f.dataType, (T.StringType, T.BooleanType)):
            out["categorical"].append(f.name)
        elif isinstance(f.dataType, T.NumericType):
            out["numeric"].append(f.name)
    return out


def low_cardinality(report: DataFrame, limit: int = 10) -> DataFrame:
    """Columns of a profile with fewer distinct values than the limit: treated as categories."""
    return report.filter(F.col("n_distinct") < limit).select("column", "data_type", "n_distinct")
