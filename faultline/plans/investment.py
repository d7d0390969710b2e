"""From the raw event log to the investment list: the whole chain in one plan."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from faultline import config
from faultline.functions import dates as D
from faultline.operators import clean, risk as K, rollup as R, sets
from faultline.operators.ordered import quantile_value
from faultline.plans.asset_table import clean_events
from faultline.session import checkpoint


def recent_share(horizon_events: str = "events_12m") -> Column:
    """A failure probability without a model: the share of an asset's events in the last window; 0 without events."""
    return F.coalesce(F.try_divide(F.col(horizon_events), F.col("n_events")).cast("double"), F.lit(0.0))


def investment_list(events: DataFrame, assets: DataFrame, spec: R.EventSpec, cutoff: str, impact: str, kind: str,
                    multipliers: Mapping[str, float], probability: Callable[[], Column] = recent_share,
                    longest: float = config.MAX_OUTAGE_MINUTES, k: int = 100) -> DataFrame:
    """Clean the log, roll it up with its outages, add the assets that never failed, and rank by probability times
    consequence (outage minutes x impact x weight of the asset's kind).

    ``assets`` lists every asset once with its ``kind``. One rollup gives history, impact and outages alike; one stored
    asset table serves the ranking.
    """
    minutes = D.duration(spec.ts, spec.end, "minute")
    log = clean_events(events, spec).withColumn("outage", F.when((minutes > 0) & (minutes < longest), minutes))
    history = R.rollup(log, replace(spec, means=(*spec.means, "outage")), cutoff)
    failed = history.select(spec.entity, "n_events", "events_12m", f"{impact}_mean", "outage_mean")
    healthy = clean.without(assets.select(spec.entity), history, spec.entity)
    mixed = checkpoint(sets.union_mixed(failed, healthy).join(assets, spec.entity))
    typical = quantile_value(mixed, "outage_mean", 0.5)
    scored = mixed.withColumns({
        "pof": probability(),
        "avg_outage_minutes": F.coalesce("outage_mean", typical, F.lit(config.DEFAULT_OUTAGE_MINUTES)),
        "customers_affected": F.coalesce(f"{impact}_mean", F.lit(config.DEFAULT_CUSTOMERS)),
    })
    raw = F.col("avg_outage_minutes") * F.col("customers_affected") * K.customer_multiplier(kind, multipliers)
    ranked = K.risk(scored.withColumn("cof_raw", raw), "pof")
    return K.capex(ranked, spec.entity, k)
