"""Survival records from an event log, Kaplan-Meier curves and the concordance index."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from faultline import config
from faultline.functions import dates as D
from faultline.operators.clean import history, without
from faultline.operators.ordered import cumulative, event_chain


def survival_intervals(events: DataFrame, entity: str, ts: str, cutoff: str, block: str = "day") -> DataFrame:
    """One record per event that is followed by a later one, the last one censored at the cutoff.

    Events at one instant give a single record (the others would last zero days and are dropped), so
    the chain of distinct instants is enough and ``failure_number`` is the ordinal of the last of them.
    """
    chain = event_chain(history(events, ts, cutoff), entity, ts, block)
    end = F.coalesce(F.col("next_ts"), D.moment(cutoff).cast("timestamp_ntz"))
    return chain.select(
        entity, F.col(ts).alias("observed_at"), D.elapsed_days(ts, end).cast("int").alias("time_to_event"),
        F.col("next_ts").isNotNull().cast("int").alias("event_occurred"), F.col("seq").alias("failure_number"),
    ).filter(F.col("time_to_event") > 0)


def censored_healthy(assets: DataFrame, events: DataFrame, entity: str, cutoff: str, age_days: str | None = None,
                     age_years: str | None = None, default_days: int = config.DEFAULT_CENSORED_DAYS) -> DataFrame:
    """Never-failed assets as censored records of their age: days, else years, else a default."""
    options = []
    if age_days is not None:
        options.append(F.col(age_days).cast("double"))
    if age_years is not None:
        options.append(F.col(age_years) * 365.25)
    days = F.coalesce(*options, F.lit(float(default_days))).cast("int")
    healthy = without(assets, events, entity)
    aged = healthy.withColumn("time_to_event", days).filter(F.col("time_to_event") > 0)
    observed = F.timestamp_micros(D.moment_micros(cutoff) - F.col("time_to_event").cast("bigint") * D.DAY_US)
    return aged.select(entity, observed.cast("timestamp_ntz").alias("observed_at"), "time_to_event",
                       F.lit(0).alias("event_occurred"), F.lit(0).cast("bigint").alias("failure_number"))


def add_censored(intervals: DataFrame, healthy: DataFrame) -> DataFrame:
    return intervals.unionByName(healthy)


def kaplan_meier(records: DataFrame, time: str, event: str, by: str, z: float = 1.959963984540054) -> DataFrame:
    """Survival curve per class with a log-log confidence band.

    Records are counted per (class, day) first; the running sums see at most one row per day and class.
    """
    daily = records.groupBy(by, time).agg(F.sum(F.col(event).cast("bigint")).alias("events"),
                                          F.count(F.lit(1)).alias("leaving"))
    w = Window.partitionBy(by)
    later = w.orderBy(F.col(time).desc()).rowsBetween(Window.unboundedPreceding, 0)
    upto = w.orderBy(F.col(time)).rowsBetween(Window.unboundedPreceding, 0)
    at_risk = daily.withColumn("at_risk", F.sum("leaving").over(later))
    d, n = F.col("events"), F.col("at_risk")
    steps = at_risk.withColumns({
        "_log": F.when(d < n, F.log1p(-d / n)).otherwise(F.lit(0.0)),
        "_dead": (d == n).cast("int"),
        "_var": F.when(d < n, d / (n * (n - d))).otherwise(F.lit(0.0)),
    })
    s = F.when(F.max("_dead").over(upto) == 1, F.lit(0.0)).otherwise(F.exp(F.sum("_log").over(upto)))
    curve = steps.withColumns({"survival": s, "_v": F.sum("_var").over(upto)})
    inner = (F.col("survival") > 0) & (F.col("survival") < 1)
    loglog = F.log(-F.log(F.when(inner, F.col("survival"))))
    width = F.lit(z) * F.sqrt("_v") / F.log(F.when(inner, F.col("survival")))
    return curve.select(
        by, F.col(time).alias("time"), "events", "at_risk", "survival",
        F.coalesce(F.exp(-F.exp(loglog - width)), F.col("survival")).alias("lower"),
        F.coalesce(F.exp(-F.exp(loglog + width)), F.col("survival")).alias("upper"))


def median_survival(curve: DataFrame, by: str) -> DataFrame:
    """First day at which half have failed; missing where the curve stays above."""
    return curve.groupBy(by).agg(F.min(F.when(F.col("survival") <= 0.5, F.col("time"))).alias("median_days"))


def concordance(records: DataFrame, time: str, event: str, risk: str) -> DataFrame:
    """Concordance index over all comparable pairs, exactly, without forming pairs.

    Two records compare when the earlier one is an event (an event precedes a censoring on its day).
    With k = 2 x day + censored (days counted from the first), two different k part at one highest bit:
    the record with 0 there is the earlier. The number of bits comes from the times. Per bit and common prefix, counts by ascending risk give the number of later records
    below and level with each event, so the work is one sorted pass over (records x bits), and every
    group is cut into blocks.
    """
    day = F.col(time).cast("bigint")
    span = records.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).first()
    low = span["lo"] or 0
    bits = (2 * ((span["hi"] or 0) - low) + 1).bit_length()
    k = (day - F.lit(low)) * 2 + F.when(F.col(event) == 1, F.lit(0)).otherwise(F.lit(1))
    counted = records.select(k.alias("_k"), F.col(risk).cast("double").alias("_risk"), F.col(event).alias("_e")).groupBy(
        "_k", "_risk", "_e").agg(F.count(F.lit(1)).alias("_c"))
    bit = F.explode(F.sequence(F.lit(0), F.lit(bits - 1))).alias("_bit")
    spread = counted.select("*", bit).withColumns({
        "_prefix": F.expr("shiftright(_k, _bit + 1)"), "_side": F.expr("shiftright(_k, _bit) & 1")})
    early = F.when((F.col("_side") == 0) & (F.col("_e") == 1), F.col("_c")).otherwise(F.lit(0))
    late = F.when(F.col("_side") == 1, F.col("_c")).otherwise(F.lit(0))
    c = cumulative(spread, "_risk", {"early": F.sum(early), "late": F.sum(late)}, by=["_bit", "_prefix"])
    e = F.col("early").cast("double")
    return c.agg(
        F.sum(e * F.col("late_before")).alias("concordant"), F.sum(e * F.col("late")).alias("tied"),
        F.sum(e * F.col("late_total")).alias("comparable"),
    ).withColumn("c_index", F.try_divide(F.col("concordant") + F.col("tied") * 0.5, "comparable"))
