"""Event-to-asset rollup queries on orders (asset = customer, event = order)."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.catalog import register, table
from faultline.operators import clean, ordered, rollup as R
from faultline.plans.asset_table import asset_reliability

CUTOFF = "2000-06-25 00:00:00"
EVENT_CUTOFF = "2024-01-20 00:00:00"
SPEC = R.EventSpec(entity="o_custkey", ts="o_orderdate", tiebreak=("o_orderkey",))
DAYS = "floor((epoch_us({b}) - epoch_us({a})) / 86400000000)"


def days_sql(a: str, b: str) -> str:
    return f"CAST({DAYS.format(a=a, b=b)} AS BIGINT)"


RELIABILITY_SQL = f"""
WITH h AS (SELECT *, TIMESTAMP '{CUTOFF}' AS c FROM orders
           WHERE o_orderdate <= TIMESTAMP '{CUTOFF}' AND o_custkey IS NOT NULL),
g AS (SELECT o_custkey, max(CASE WHEN gap <= 30 THEN 1 ELSE 0 END) AS recurs_30d,
             max(CASE WHEN gap <= 90 THEN 1 ELSE 0 END) AS recurs_90d
      FROM (SELECT o_custkey, {days_sql("lag(o_orderdate) OVER w", "o_orderdate")} AS gap FROM h
            WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)) GROUP BY 1),
a AS (SELECT o_custkey, count(*) AS n_events, min(o_orderdate) AS first_event, max(o_orderdate) AS last_event,
       CAST(sum(CASE WHEN month(o_orderdate) IN (6,7,8,9) THEN 1 ELSE 0 END) AS BIGINT) AS summer_events,
       CAST(sum(CASE WHEN month(o_orderdate) IN (12,1,2) THEN 1 ELSE 0 END) AS BIGINT) AS winter_events,
       CAST(sum(CASE WHEN o_orderdate >= c - INTERVAL 90 DAY THEN 1 ELSE 0 END) AS BIGINT) AS events_3m,
       CAST(sum(CASE WHEN o_orderdate >= c - INTERVAL 180 DAY THEN 1 ELSE 0 END) AS BIGINT) AS events_6m,
       CAST(sum(CASE WHEN o_orderdate >= c - INTERVAL 365 DAY THEN 1 ELSE 0 END) AS BIGINT) AS events_12m,
       any_value(c) AS c FROM h GROUP BY 1),
m AS (SELECT *, {days_sql("first_event", "last_event")} AS span, {days_sql("first_event", "c")} AS obs,
       {days_sql("last_event", "c")} AS days_since_last FROM a),
r AS (SELECT *, CASE WHEN n_events >= 2 AND span > 0 THEN span::DOUBLE / (n_events - 1) END AS mtbf_days,
       CASE WHEN n_events >= 2 AND obs > 0 THEN obs::DOUBLE / n_events END AS mtbf_observable_days FROM m)
SELECT r.o_custkey, n_events, first_event, last_event, summer_events, winter_events, events_3m, events_6m, events_12m,
       recurs_30d, recurs_90d, round(mtbf_days, 6) AS mtbf_days,
       round(mtbf_observable_days, 6) AS mtbf_observable_days, days_since_last,
       round(mtbf_observable_days / mtbf_days, 6) AS degradation_ratio,
       CASE WHEN coalesce(mtbf_observable_days / mtbf_days, 0) > 1.5 THEN 1 ELSE 0 END AS is_degrading,
       round(CASE WHEN mtbf_days > 0 THEN least(100.0, mtbf_days / 365.0 * 100.0) ELSE 0.0 END, 6) AS reliability_score,
       round(CASE WHEN mtbf_days > 0 THEN days_since_last / mtbf_days END, 6) AS overdue_factor
FROM r JOIN g USING (o_custkey)
"""


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@register("asset_reliability", RELIABILITY_SQL)
def asset_reliability_query(spark, folder):
    out = asset_reliability(table(spark, folder, "orders"), SPEC, CUTOFF)
    return rounded(out, "mtbf_days", "mtbf_observable_days", "degradation_ratio", "reliability_score",
                   "overdue_factor")


# The fault log used below: every order is an outage of its customer. Install date, outage end and
# voltage are computed from order columns so that the optional parts of the log are exercised too.
FAULT_SQL = """
f AS (SELECT o_custkey AS asset, o_orderkey AS event_id, o_orderdate AS started,
       o_orderdate + to_microseconds(CAST(round(sqrt(o_totalprice) * 1000000000) AS BIGINT)) AS ended,
       o_orderpriority AS cause, o_orderstatus AS status, sqrt(o_totalprice) AS impact,
       TIMESTAMP '1996-01-01' - to_days(CAST(o_custkey * 7 % 9000 AS INTEGER)) AS install
      FROM orders)"""
FAULT_SPEC = R.EventSpec(entity="asset", ts="started", tiebreak=("event_id",), end="ended", install="install",
                         cause="cause", first_of=("status",), means=("impact",), means_and_maxima=("weight",))


def fault_log(spark, folder):
    o = table(spark, folder, "orders")
    end = F.timestamp_micros(F.unix_micros(F.col("o_orderdate").cast("timestamp"))
                             + F.round(F.sqrt("o_totalprice") * 1_000_000_000).cast("bigint"))
    install = F.date_sub(F.lit("1996-01-01").cast("date"), (F.col("o_custkey") * 7 % 9000).cast("int"))
    return o.select(
        F.col("o_custkey").alias("asset"), F.col("o_orderkey").alias("event_id"),
        F.col("o_orderdate").alias("started"), end.cast("timestamp_ntz").alias("ended"),
        F.col("o_orderpriority").alias("cause"), F.col("o_orderstatus").alias("status"),
        F.sqrt("o_totalprice").alias("impact"), install.cast("timestamp_ntz").alias("install"),
    )


# The log after the temporal exclusion and up to the cutoff.
HISTORY_SQL = f"""WITH {FAULT_SQL.strip()},
h AS (SELECT * FROM f WHERE started <= TIMESTAMP '{CUTOFF}' AND NOT coalesce(started < install, false))"""

ROLLUP_SQL = f"""{HISTORY_SQL},
k AS (SELECT asset, cause, count(*) AS k FROM h WHERE cause IS NOT NULL GROUP BY 1, 2),
cp AS (SELECT asset, count(*) AS cause_diversity, max(k)::DOUBLE / sum(k) AS cause_consistency,
        arg_min(cause, (-k, cause)) AS cause_mode FROM k GROUP BY 1),
g AS (SELECT asset, max(CASE WHEN gap <= 30 THEN 1 ELSE 0 END) AS recurs_30d,
       max(CASE WHEN gap <= 90 THEN 1 ELSE 0 END) AS recurs_90d
      FROM (SELECT asset, {days_sql("lag(started) OVER w", "started")} AS gap FROM h
            WINDOW w AS (PARTITION BY asset ORDER BY started, event_id)) GROUP BY 1),
a AS (SELECT asset, count(*) AS n_events, min(started) AS first_event, max(started) AS last_event,
       CAST(count(*) FILTER (month(started) IN (6,7,8,9)) AS BIGINT) AS summer_events,
       CAST(count(*) FILTER (month(started) IN (12,1,2)) AS BIGINT) AS winter_events,
       count(*) FILTER (started >= TIMESTAMP '{CUTOFF}' - INTERVAL 90 DAY) AS events_3m,
       count(*) FILTER (started >= TIMESTAMP '{CUTOFF}' - INTERVAL 180 DAY) AS events_6m,
       count(*) FILTER (started >= TIMESTAMP '{CUTOFF}' - INTERVAL 365 DAY) AS events_12m,
       avg((epoch_us(ended) - epoch_us(started)) / 3600000000) AS repair_hours_mean,
       max((epoch_us(ended) - epoch_us(started)) / 3600000000) AS repair_hours_max,
       first(status ORDER BY started, event_id) AS status, first(install ORDER BY started, event_id) AS install,
       first(cause ORDER BY started, event_id) AS cause_first, last(cause ORDER BY started, event_id) AS cause_last,
       avg(impact) AS impact_mean, avg(impact / 10) AS weight_mean, max(impact / 10) AS weight_max
      FROM h GROUP BY 1),
t0 AS (SELECT a.*, g.recurs_30d, g.recurs_90d, cp.cause_diversity, cp.cause_consistency, cp.cause_mode,
       {days_sql("first_event", "last_event")} AS span,
       {days_sql("first_event", f"TIMESTAMP '{CUTOFF}'")} AS obs,
       {days_sql("last_event", f"TIMESTAMP '{CUTOFF}'")} AS days_since_last,
       {days_sql("install", f"TIMESTAMP '{CUTOFF}'")} AS age_days,
       {days_sql("install", "first_event")} AS days_to_first
      FROM a JOIN g USING (asset) LEFT JOIN cp USING (asset)),
assets AS (SELECT *, CASE WHEN n_events >= 2 AND span > 0 THEN span::DOUBLE / (n_events - 1) END AS mtbf_days,
       CASE WHEN n_events >= 2 AND obs > 0 THEN obs::DOUBLE / n_events END AS mtbf_observable_days,
       CASE WHEN age_days > 0 THEN age_days::DOUBLE / n_events END AS mtbf_lifetime_days,
       age_days / 365.25::DOUBLE AS age_years, days_to_first / 365.25::DOUBLE AS years_to_first FROM t0)"""


def history_log(spark, folder):
    kept, _ = clean.exclude_before_install(clean.history(fault_log(spark, folder), "started", CUTOFF),
                                           "started", "install")
    return kept.withColumn("weight", F.col("impact") / 10)


def asset_table(spark, folder):
    return R.reliability(R.rollup(history_log(spark, folder), FAULT_SPEC, CUTOFF), CUTOFF, "install")


@register("asset_rollup", f"""{ROLLUP_SQL}
SELECT asset, n_events, first_event, last_event, summer_events, winter_events, events_3m, events_6m, events_12m,
 round(repair_hours_mean, 3) AS repair_hours_mean, round(repair_hours_max, 3) AS repair_hours_max, status, install,
 cause_first, cause_last, round(impact_mean, 4) AS impact_mean, round(weight_mean, 6) AS weight_mean,
 round(weight_max, 6) AS weight_max, recurs_30d, recurs_90d, cause_diversity,
 round(cause_consistency, 6) AS cause_consistency, cause_mode FROM assets""")
def asset_rollup(spark, folder):
    out = R.rollup(history_log(spark, folder), FAULT_SPEC, CUTOFF)
    out = rounded(rounded(out, "impact_mean", digits=4), "repair_hours_mean", "repair_hours_max", digits=3)
    return rounded(out, "weight_mean", "weight_max", "cause_consistency")


@register("mtbf_measures", f"""{ROLLUP_SQL}
SELECT asset, round(mtbf_days, 6) AS mtbf_days, round(mtbf_lifetime_days, 6) AS mtbf_lifetime_days,
 round(mtbf_observable_days, 6) AS mtbf_observable_days, round(1 / mtbf_lifetime_days, 9) AS hazard_rate,
 round(mtbf_observable_days / mtbf_days, 6) AS degradation_ratio,
 CASE WHEN coalesce(mtbf_observable_days / mtbf_days, 0) > 1.5 THEN 1 ELSE 0 END AS is_degrading,
 age_days, 'GRID_CONNECTION' AS age_source FROM assets""")
def mtbf_measures(spark, folder):
    out = rounded(asset_table(spark, folder), "mtbf_days", "mtbf_lifetime_days", "mtbf_observable_days",
                  "degradation_ratio")
    return out.select("asset", "mtbf_days", "mtbf_lifetime_days", "mtbf_observable_days",
                      F.round("hazard_rate", 9).alias("hazard_rate"), "degradation_ratio", "is_degrading",
                      "age_days", "age_source")


@register("failure_recency", f"""{ROLLUP_SQL}
SELECT asset, first_event, last_event, days_since_last, days_to_first, round(years_to_first, 6) AS years_to_first
FROM assets""")
def failure_recency(spark, folder):
    return rounded(asset_table(spark, folder).select("asset", "first_event", "last_event", "days_since_last",
                                                     "days_to_first", "years_to_first"), "years_to_first")


@register("recurrence_events", f"""
WITH g AS (SELECT user_id, {days_sql("lag(ts) OVER w", "ts")} AS gap FROM events
           WHERE ts <= TIMESTAMP '{EVENT_CUTOFF}'
           WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, max(CASE WHEN gap <= 1 THEN 1 ELSE 0 END) AS recurs_1d,
  max(CASE WHEN gap <= 2 THEN 1 ELSE 0 END) AS recurs_2d FROM g GROUP BY 1""")
def recurrence_events(spark, folder):
    spec = R.EventSpec(entity="user_id", ts="ts", tiebreak=("event_id",), recurrence_days=(1, 2))
    return R.rollup(table(spark, folder, "events"), spec, EVENT_CUTOFF).select("user_id", "recurs_1d", "recurs_2d")


@register("mode_per_asset", """
WITH k AS (SELECT user_id, event_type, count(*) AS k FROM events GROUP BY 1, 2)
SELECT user_id, event_type AS mode FROM
 (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY k DESC, event_type) AS rn FROM k) WHERE rn = 1""")
def mode_per_asset(spark, folder):
    return R.mode_by(table(spark, folder, "events"), "user_id", "event_type")


@register("first_last_per_asset", """
SELECT user_id, first(event_type ORDER BY ts, event_id) AS first_value, last(event_type ORDER BY ts, event_id) AS last_value
FROM events GROUP BY 1""")
def first_last_per_asset(spark, folder):
    return R.first_last(table(spark, folder, "events"), "user_id", "ts", ["event_id"], "event_type")


@register("cause_profile", """
WITH k AS (SELECT l_suppkey, l_returnflag || l_linestatus AS c, count(*) AS k FROM lineitem GROUP BY 1, 2)
SELECT l_suppkey, count(*) AS cause_diversity, round(max(k)::DOUBLE / sum(k), 6) AS cause_consistency,
 arg_min(c, (-k, c)) AS cause_mode FROM k GROUP BY 1""")
def cause_profile(spark, folder):
    li = table(spark, folder, "lineitem").select("l_suppkey", F.concat("l_returnflag", "l_linestatus").alias("c"))
    return rounded(R.cause_profile(li, "l_suppkey", "c"), "cause_consistency")


@register("event_gaps", f"""
WITH p AS (SELECT user_id, ts, count(*) AS n FROM events GROUP BY 1, 2)
SELECT user_id, ts, n, lag(ts) OVER w AS prev_ts, {days_sql("lag(ts) OVER w", "ts")} AS gap_days FROM p
WINDOW w AS (PARTITION BY user_id ORDER BY ts)""")
def event_gaps(spark, folder):
    return ordered.gaps(table(spark, folder, "events"), "user_id", "ts")


@register("event_ordinals", """
WITH p AS (SELECT o_custkey, o_orderdate, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT o_custkey, o_orderdate, n, CAST(sum(n) OVER w AS BIGINT) AS seq, lead(o_orderdate) OVER w AS next_ts FROM p
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate)""")
def event_ordinals(spark, folder):
    return ordered.event_chain(table(spark, folder, "orders"), "o_custkey", "o_orderdate").drop("prev_ts")
