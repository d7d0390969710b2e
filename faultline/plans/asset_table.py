"""From the event log to the asset table, the feature table and the risk table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from faultline import config
from faultline.functions import dates as D, scalars as S
from faultline.operators import clean, rollup as R


def asset_reliability(events: DataFrame, spec: R.EventSpec, cutoff: str) -> DataFrame:
    """The flagship query: history up to the cutoff as one row per asset with its reliability measures."""
    assets = R.reliability(R.rollup(events, spec, cutoff), cutoff, spec.install)
    return assets.withColumns({
        "reliability_score": S.reliability_score("mtbf_days"),
        "overdue_factor": S.overdue_factor("days_since_last", "mtbf_days", "n_events"),
    })


def clean_events(events: DataFrame, spec: R.EventSpec) -> DataFrame:
    """Id filter, exact and keyed deduplication, exclusion of events before installation."""
    rows = clean.dedup_exact(clean.require_id(events, spec.entity))
    keys = [spec.entity, spec.ts]
    rest = [c for c in rows.columns if c not in keys and c not in spec.tiebreak]
    rows = clean.dedup_by_key(rows, keys, [*spec.tiebreak, *rest])
    if spec.install is not None:
        rows, _ = clean.exclude_before_install(rows, spec.ts, spec.install)
    return rows


def feature_table(assets: DataFrame, asset_class: str, district: str | None = None, customers: str | None = None,
                  volts: str | None = None) -> DataFrame:
    """Engineered features on the asset table; a feature whose inputs are missing is left out."""
    have = set(assets.columns)
    out = assets.withColumns({
        "is_healthy": S.healthy_mask(assets.columns),
        "expected_life": S.expected_life(asset_class),
        "reliability_score": S.reliability_score("mtbf_days"),
        "time_since_last_norm": S.time_since_last_normalized("days_since_last", "mtbf_days"),
        "overdue_factor": S.overdue_factor("days_since_last", "mtbf_days", "n_events"),
        "failure_free_3m": S.failure_free("events_3m"),
        "mtbf_trend": S.mtbf_trend("days_since_last", "mtbf_days", "n_events"),
        "last_event_season": D.season("last_event"),
        "loading_score": S.loading_score("days_since_last"),
    })
    if "age_years" in have:
        out = out.withColumn("age_ratio", S.age_ratio("age_years", "expected_life"))
        out = out.withColumns({
            "age_risk": S.cut("age_ratio", *config.AGE_RISK_BINS),
            "age_ratio_x_recurrence": F.col("age_ratio") * F.col("recurs_90d"),
        })
    if "mtbf_lifetime_days" in have:
        out = out.withColumn("mtbf_variability",
                             S.mtbf_variability("mtbf_lifetime_days", "mtbf_observable_days", "n_events"))
    if district is not None:
        out = out.withColumn("region_type", S.region_type(district))
    if volts is not None:
        out = out.withColumn("voltage_class", S.voltage_class(volts))
        out = out.withColumns(S.voltage_flags("voltage_class"))
    if customers is not None:
        out = out.withColumn("customer_minutes_annual", S.customer_minutes(customers, "events_12m"))
        out = out.withColumn("impact_category", S.cut("customer_minutes_annual", *config.IMPACT_BINS))
    if "cause_mode" in have:
        out = out.withColumns(S.cause_flags("cause_consistency", "cause_diversity", "cause_first", "cause_last"))
        out = out.withColumn("class_cause", S.combine(asset_class, "cause_mode"))
        out = R.class_means(out, F.col("class_cause"), "n_events", "class_cause_risk")
    return out
