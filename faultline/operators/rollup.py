"""Event log to one row per asset, as of a cutoff.

One scan and two shuffles: partial results per (asset, bucket, cause and text attributes) combine map-side, so an asset
with a large share of all events is already small when it meets its own rows. All partial results have a fixed
width, so they are kept in hash tables and the log is never sorted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from faultline.functions import dates as D
from faultline.functions.scalars import flag
from faultline.operators.clean import history
from faultline.session import checkpoint


@dataclass(frozen=True)
class EventSpec:
    """Column names of an event log. Optional parts that are None or empty are left out of the result.

    ``cause`` and the text columns among ``first_of`` are categories: an asset keeps one row per combination and bucket. The first
    of a free text is what ``first_last`` is for.
    """

    entity: str
    ts: str
    tiebreak: Sequence[str] = ()
    end: str | None = None
    install: str | None = None
    cause: str | None = None
    first_of: Sequence[str] = ()
    means: Sequence[str] = ()
    means_and_maxima: Sequence[str] = ()
    windows: dict[str, int] = field(default_factory=lambda: {"3m": 90, "6m": 180, "12m": 365})
    recurrence_days: Sequence[int] = (30, 90)


# Width of the recurrence buckets. Two events of one bucket are closer than the smallest gap asked for.
def _bucket(ts: Column, width_days: int) -> Column:
    return F.floor(D.micros(ts) / F.lit(width_days * D.DAY_US)).cast("bigint")


def _place(rows: DataFrame, ts: str, tiebreak: Sequence[str]) -> Column:
    """The place of an event in time as one comparable value: a number where one whole number breaks ties (a missing one
    coming first), else a struct, with which the rollup sorts instead of hashing."""
    if not tiebreak:
        return F.col(ts)
    if len(tiebreak) > 1 or not isinstance(rows.schema[tiebreak[0]].dataType, T.IntegralType):
        return F.struct(F.col(ts), *[F.col(c) for c in tiebreak])
    least = F.coalesce(F.col(tiebreak[0]).cast("decimal(20,0)") + F.lit(Decimal(2**63 + 1)), F.lit(Decimal(0)))
    return D.micros(ts).cast("decimal(20,0)") * F.lit(Decimal(2**65)) + least


def rollup(events: DataFrame, spec: EventSpec, cutoff: str) -> DataFrame:
    """Counts, extremes, window and season sums, repair hours, first attributes, means, causes and recurrence flags."""
    e, ts = spec.entity, spec.ts
    rows = history(events, ts, cutoff).filter(F.col(e).isNotNull())
    place = _place(rows, ts, spec.tiebreak)
    width = min(spec.recurrence_days)

    partial: list[Column] = [
        F.count(F.lit(1)).alias("_n"), F.min(ts).alias("_first"), F.max(ts).alias("_last"),
        F.min(place).alias("_from"), F.max(place).alias("_to"),
        F.sum(D.summer_flag(ts)).alias("_summer"), F.sum(D.winter_flag(ts)).alias("_winter"),
    ]
    final: list[Column] = [
        F.sum("_n").alias("n_events"), F.min("_first").alias("first_event"), F.max("_last").alias("last_event"),
        F.sum("_summer").alias("summer_events"), F.sum("_winter").alias("winter_events"),
    ]
    for name, days in spec.windows.items():
        partial.append(F.sum(D.recency_flag(ts, cutoff, days)).alias(f"_w_{name}"))
        final.append(F.sum(f"_w_{name}").alias(f"events_{name}"))
    if spec.end is not None:
        hours = D.duration(ts, spec.end, "hour")
        partial += [F.sum(hours).alias("_ttr_sum"), F.count(hours).alias("_ttr_n"), F.max(hours).alias("_ttr_max")]
        final += [F.try_divide(F.sum("_ttr_sum"), F.sum("_ttr_n")).alias("repair_hours_mean"),
                  F.max("_ttr_max").alias("repair_hours_max")]
    # Text is part of the key, as no hash table holds it as a value.
    keys, firsts = {}, {}
    for i, c in enumerate([*spec.first_of, *([spec.install] if spec.install else [])]):
        if isinstance(rows.schema[c].dataType, (T.NumericType, T.DatetimeType, T.BooleanType)):
            known = F.when(F.col(c).isNotNull(), place)
            partial += [F.min_by(F.col(c), known).alias(f"_f{i}"), F.min(known).alias(f"_fo{i}")]
            final.append(F.min_by(F.col(f"_f{i}"), F.col(f"_fo{i}")).alias(c))
        else:
            keys[f"_f{i}"], firsts[c] = F.col(c), f"_f{i}"
    if spec.cause is not None:
        keys["_cause"], firsts["cause_first"] = F.col(spec.cause), "_cause"
    for c in [*spec.means, *spec.means_and_maxima]:
        x = F.col(c).cast("double")
        partial += [F.sum(x).alias(f"_s_{c}"), F.count(x).alias(f"_c_{c}")]
        final.append(F.try_divide(F.sum(f"_s_{c}"), F.sum(f"_c_{c}")).alias(f"{c}_mean"))
    for c in spec.means_and_maxima:
        partial.append(F.max(c).alias(f"_m_{c}"))
        final.append(F.max(f"_m_{c}").alias(f"{c}_max"))

    parts = rows.groupBy(e, _bucket(F.col(ts), width).alias("_bucket"), *[c.alias(k) for k, c in keys.items()]).agg(*partial)
    # The windows below share the rows of an asset; a bucket follows from the place, so places order buckets too.
    whole = Window.partitionBy(e).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.partitionBy(e).orderBy("_from", *keys)
    earlier = F.max("_last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    within = F.when(F.col("_n") > 1, F.lit(0).cast("bigint"))
    out = parts.select(
        "*", F.least(within, D.elapsed_days(earlier, F.col("_first"))).alias("_gap"),  # least() skips nulls
        *[F.first(k, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(f"_v{i}")
          for i, k in enumerate(firsts.values())])
    found = {name: f"_v{i}" for i, name in enumerate(firsts)}
    for d in spec.recurrence_days:
        final.append(F.max(flag(F.col("_gap") <= d)).alias(f"recurs_{d}d"))
    if spec.cause is not None:
        known = F.col("_cause").isNotNull()
        same = Window.partitionBy(e, "_cause").orderBy("_from")
        out = out.select(
            "*", F.when(known, F.sum("_n").over(same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_k"),
            flag(known & (F.row_number().over(same) == 1)).alias("_new"))
        out = out.select("*", F.max("_k").over(whole).alias("_most"), F.max(F.when(known, F.col("_to"))).over(whole).alias("_end"))
        out = out.select(
            "*", F.min(F.when(F.col("_k") == F.col("_most"), F.col("_cause"))).over(whole).alias("_mode"),
            F.max(F.when(F.col("_to") == F.col("_end"), F.col("_cause"))).over(whole).alias("_late"))
        found |= {"cause_last": "_late", "cause_mode": "_mode"}
        share = F.try_divide(F.max("_k"), F.sum(F.when(known, F.col("_n"))))
        final += [F.sum("_new").cast("bigint").alias("cause_diversity"), F.coalesce(share, F.lit(0.0)).alias("cause_consistency")]
    return out.groupBy(e, *[F.col(k).alias(name) for name, k in found.items()]).agg(*final)


def cause_profile(rows: DataFrame, entity: str, cause: str) -> DataFrame:
    """Distinct causes, share of the most frequent one, and that cause (ties: the smallest)."""
    counts = (
        rows.filter(F.col(entity).isNotNull() & F.col(cause).isNotNull())
        .groupBy(entity, cause).agg(F.count(F.lit(1)).alias("_k"))
    )
    top = F.min(F.struct((-F.col("_k")).alias("k"), F.col(cause).alias("c")))
    return counts.groupBy(entity).agg(
        F.count(F.lit(1)).alias("cause_diversity"),
        (F.max("_k") / F.sum("_k")).alias("cause_consistency"),
        top.getField("c").alias("cause_mode"),
    )


def mode_by(rows: DataFrame, entity: str, column: str) -> DataFrame:
    return cause_profile(rows, entity, column).select(entity, F.col("cause_mode").alias("mode"))


def first_last(rows: DataFrame, entity: str, ts: str, tiebreak: Sequence[str], column: str) -> DataFrame:
    known = F.when(F.col(column).isNotNull(), F.struct(ts, *tiebreak))
    return rows.filter(F.col(entity).isNotNull()).groupBy(entity).agg(
        F.min_by(F.col(column), known).alias("first_value"), F.max_by(F.col(column), known).alias("last_value"))


def mtbf_interfault(n: Column, first: Column, last: Column) -> Column:
    days = D.elapsed_days(first, last)
    return F.when((n >= 2) & (days > 0), days / (n - 1))


def mtbf_lifetime(n: Column, install: Column, cutoff: str) -> Column:
    days = D.elapsed_days(install, D.moment(cutoff))
    return F.when((n > 0) & (days > 0), days / n)


def mtbf_observable(n: Column, first: Column, cutoff: str) -> Column:
    days = D.elapsed_days(first, D.moment(cutoff))
    return F.when((n >= 2) & (days > 0), days / n)


def reliability(assets: DataFrame, cutoff: str, install: str | None = None) -> DataFrame:
    """Mean times between failures, degradation, hazard and recency from the rolled-up counts."""
    n, first, last = F.col("n_events"), F.col("first_event"), F.col("last_event")
    out = assets.withColumns({
        "mtbf_days": mtbf_interfault(n, first, last),
        "mtbf_observable_days": mtbf_observable(n, first, cutoff),
        "days_since_last": D.elapsed_days(last, D.moment(cutoff)),
    })
    if install is not None:
        out = out.withColumns({
            "age_days": D.asset_age_days(install, cutoff),
            "age_source": D.age_source(install, cutoff),
            "mtbf_lifetime_days": mtbf_lifetime(n, F.col(install), cutoff),
            "days_to_first": D.elapsed_days(install, first),
        })
        out = out.withColumns({
            "age_years": D.years("age_days"),
            "hazard_rate": F.try_divide(F.lit(1.0), F.col("mtbf_lifetime_days")),
            "years_to_first": D.years("days_to_first"),
        })
    out = out.withColumn("degradation_ratio", F.try_divide(F.col("mtbf_observable_days"), F.col("mtbf_days")))
    return out.withColumn("is_degrading", flag(F.col("degradation_ratio") > 1.5))


def class_means(assets: DataFrame, key: Column, value: str, name: str) -> DataFrame:
    """Group-mean encoding: the mean of ``value`` over assets with the same key, joined back.

    A join to the aggregate, not a window, so a key that many assets share stays spread out; the asset
    rows are written once because both sides read them.
    """
    keyed = checkpoint(assets.withColumn("_key", key))
    means = keyed.groupBy("_key").agg(F.avg(value).alias(name))
    return keyed.join(means, "_key", "left").drop("_key")
