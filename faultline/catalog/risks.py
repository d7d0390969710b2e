"""Labels, the mixed asset table, consequence, risk and the investment list."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.catalog import register, table
from faultline.catalog.assets import (CUTOFF, FAULT_SQL, HISTORY_SQL, asset_table, days_sql, fault_log, history_log,
                                      rounded)
from faultline.functions import dates as D, scalars as S
from faultline.operators import clean, labels as L, risk as K, segments, sets
from faultline.operators.rollup import EventSpec
from faultline.plans.investment import investment_list
from faultline.session import checkpoint

EARLY = "1995-09-25 00:00:00"  # many customers have no order before it, so both groups are large
TARGET_SQL = f"""t AS (SELECT c_custkey AS asset,
 CAST(coalesce(max(CASE WHEN o_orderdate <= TIMESTAMP '{CUTOFF}' + INTERVAL 3 MONTH THEN 1 END), 0) AS INTEGER) AS target_3M,
 CAST(coalesce(max(CASE WHEN o_orderdate <= TIMESTAMP '{CUTOFF}' + INTERVAL 6 MONTH THEN 1 END), 0) AS INTEGER) AS target_6M,
 CAST(coalesce(max(CASE WHEN o_orderdate <= TIMESTAMP '{CUTOFF}' + INTERVAL 12 MONTH THEN 1 END), 0) AS INTEGER) AS target_12M
 FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{CUTOFF}') ON o_custkey = c_custkey GROUP BY 1)"""


def customers(spark, folder):
    return table(spark, folder, "customer").select(F.col("c_custkey").alias("asset"))


def targets(spark, folder):
    return L.make_targets(customers(spark, folder), fault_log(spark, folder), "asset", "started", CUTOFF)


@register("horizon_ids", f"""SELECT DISTINCT o_custkey AS asset FROM orders WHERE o_orderdate > TIMESTAMP '{CUTOFF}'
 AND o_orderdate <= TIMESTAMP '{CUTOFF}' + INTERVAL 3 MONTH""")
def horizon_ids(spark, folder):
    return L.horizon_ids(fault_log(spark, folder), "asset", "started", CUTOFF, 3)


@register("horizon_targets", f"WITH {TARGET_SQL} SELECT * FROM t")
def horizon_targets(spark, folder):
    return targets(spark, folder)


@register("unmatched_future_ids", f"""
SELECT DISTINCT o_custkey AS asset FROM orders WHERE o_orderdate > TIMESTAMP '{EARLY}'
 AND o_orderdate <= TIMESTAMP '{EARLY}' + INTERVAL 6 MONTH
 AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate <= TIMESTAMP '{EARLY}')""")
def unmatched_future_ids(spark, folder):
    f = fault_log(spark, folder)
    return L.unmatched_ids(clean.history(f, "started", EARLY), f, "asset", "started", EARLY, 6)


@register("lifetime_target", f"""{HISTORY_SQL}
SELECT asset, CASE WHEN count(*) >= 2 THEN 1 ELSE 0 END AS target_lifetime FROM h GROUP BY 1""")
def lifetime_target(spark, folder):
    return L.lifetime_target(asset_table(spark, folder), "n_events").select("asset", "target_lifetime")


@register("chronic_target", f"""{HISTORY_SQL},
g AS (SELECT asset, {days_sql("lag(started) OVER w", "started")} AS gap FROM h
 WINDOW w AS (PARTITION BY asset ORDER BY started, event_id))
SELECT asset, max(CASE WHEN gap <= 90 THEN 1 ELSE 0 END) AS target_chronic FROM g GROUP BY 1""")
def chronic_target(spark, folder):
    return L.chronic_target(asset_table(spark, folder)).select("asset", "target_chronic")


MIXED_SQL = f"""WITH {FAULT_SQL.strip()},
h AS (SELECT * FROM f WHERE started <= TIMESTAMP '{EARLY}'),
a AS (SELECT asset, count(*) AS n_events, min(started) AS first_event, max(started) AS last_event,
  1 AS has_failure_history, 'Failed_Equipment' AS data_source FROM h GROUP BY 1),
m AS (SELECT * FROM a UNION ALL SELECT c_custkey, 0, NULL, NULL, 0, 'Healthy_Equipment' FROM customer
 WHERE c_custkey NOT IN (SELECT asset FROM h))"""


def mixed(spark, folder):
    h = clean.history(fault_log(spark, folder), "started", EARLY)
    failed = h.groupBy("asset").agg(F.count(F.lit(1)).alias("n_events"), F.min("started").alias("first_event"),
                                    F.max("started").alias("last_event"))
    healthy = clean.without(customers(spark, folder), h, "asset")
    return sets.union_mixed(failed, healthy)


@register("healthy_assets", f"""
SELECT c_custkey AS asset FROM customer WHERE c_custkey NOT IN
 (SELECT o_custkey FROM orders WHERE o_orderdate <= TIMESTAMP '{EARLY}')""")
def healthy_assets(spark, folder):
    h = clean.history(fault_log(spark, folder), "started", EARLY)
    return clean.without(customers(spark, folder), h, "asset")


@register("mixed_assets", f"{MIXED_SQL} SELECT * FROM m")
def mixed_assets(spark, folder):
    return mixed(spark, folder)


@register("healthy_mask", f"{MIXED_SQL} SELECT asset, has_failure_history = 0 AS healthy FROM m")
def healthy_mask(spark, folder):
    m = mixed(spark, folder)
    return m.select("asset", S.healthy_mask(m.columns).alias("healthy"))


@register("target_distribution", f"""{MIXED_SQL}, y AS (SELECT m.asset, has_failure_history = 0 AS healthy,
 EXISTS (SELECT 1 FROM orders WHERE o_custkey = m.asset AND o_orderdate > TIMESTAMP '{EARLY}'
  AND o_orderdate <= TIMESTAMP '{EARLY}' + INTERVAL 3 MONTH)::INT AS t3,
 EXISTS (SELECT 1 FROM orders WHERE o_custkey = m.asset AND o_orderdate > TIMESTAMP '{EARLY}'
  AND o_orderdate <= TIMESTAMP '{EARLY}' + INTERVAL 6 MONTH)::INT AS t6 FROM m)
SELECT 'target_3M' AS target, healthy, count(*) AS n, CAST(sum(t3) AS BIGINT) AS positives,
 round(avg(t3) * 100, 6) AS positive_rate FROM y GROUP BY healthy
UNION ALL SELECT 'target_6M', healthy, count(*), CAST(sum(t6) AS BIGINT), round(avg(t6) * 100, 6) FROM y GROUP BY healthy""")
def target_distribution(spark, folder):
    m = mixed(spark, folder)
    t = L.make_targets(m, fault_log(spark, folder), "asset", "started", EARLY, {"3M": 3, "6M": 6})
    joined = m.select("asset", S.healthy_mask(m.columns).alias("healthy")).join(t, "asset")
    return rounded(segments.target_distribution(joined, ["target_3M", "target_6M"], "healthy"), "positive_rate")


@register("expected_positives", f"""WITH {TARGET_SQL}
SELECT 'positives 3M' AS "check", sum(target_3M)::DOUBLE AS value, 450.0::DOUBLE AS low, 500.0::DOUBLE AS high,
 CASE WHEN sum(target_3M) BETWEEN 450 AND 500 THEN 'pass' ELSE 'warn' END AS status FROM t
UNION ALL SELECT 'positive rate 12M', round(avg(target_12M), 9), 0.01, 0.5,
 CASE WHEN avg(target_12M) BETWEEN 0.01 AND 0.5 THEN 'pass' ELSE 'warn' END FROM t""")
def expected_positives(spark, folder):
    one = targets(spark, folder).agg(F.sum("target_3M").alias("p"), F.avg("target_12M").alias("r"))
    out = L.expect_count(one, "p", 475, 25, "positives 3M").unionByName(L.expect(one, "r", 0.01, 0.5, "positive rate 12M"))
    return rounded(out, "value", digits=9)


# Consequence: outage minutes of the history, customers = mean impact.
COF_SQL = f"""{HISTORY_SQL},
d AS (SELECT asset, (epoch_us(ended) - epoch_us(started)) / 60000000 AS minutes FROM h),
am AS (SELECT asset, avg(minutes) AS m FROM d WHERE minutes > 0 AND minutes < 6000 GROUP BY 1),
base AS (SELECT h.asset, avg(impact) AS impact_mean FROM h GROUP BY 1),
o AS (SELECT base.asset, impact_mean, coalesce(m, (SELECT quantile_cont(m, 0.5) FROM am), 120.0) AS avg_outage_minutes
 FROM base LEFT JOIN am USING (asset)),
c AS (SELECT *, avg_outage_minutes * impact_mean AS cof_raw FROM o),
r AS (SELECT *, (rank() OVER (ORDER BY cof_raw) + (count(*) OVER (PARTITION BY cof_raw) - 1) / 2) / count(*) OVER () * 100
 AS cof_score FROM c)"""
BAND_SQL = "CASE WHEN {s} <= 75 THEN 'DÜŞÜK' WHEN {s} <= 90 THEN 'ORTA' WHEN {s} <= 95 THEN 'YÜKSEK' WHEN {s} <= 100 THEN 'KRİTİK' END"


def outage_assets(spark, folder):
    log = history_log(spark, folder).withColumn("minutes", D.duration("started", "ended", "minute"))
    base = log.groupBy("asset").agg(F.avg("impact").alias("impact_mean"))
    return K.average_outage(base, log, "asset", "minutes", longest=6000.0)


def consequences(spark, folder):
    return K.consequence(K.affected_customers(outage_assets(spark, folder), ["impact_mean"]))


@register("average_outage", f"{COF_SQL} SELECT asset, round(avg_outage_minutes, 2) AS avg_outage_minutes FROM o")
def average_outage(spark, folder):
    return rounded(outage_assets(spark, folder).select("asset", "avg_outage_minutes"), "avg_outage_minutes", digits=2)


@register("consequence_of_failure", f"""{COF_SQL}
SELECT asset, round(cof_raw, 2) AS cof_raw, round(cof_score, 6) AS cof_score, {BAND_SQL.format(s="cof_score")} AS cof_category
FROM r""")
def consequence_of_failure(spark, folder):
    return rounded(rounded(consequences(spark, folder).select("asset", "cof_raw", "cof_score", "cof_category"),
                           "cof_raw", digits=2), "cof_score")


@register("consequence_cutoffs", f"""{COF_SQL}
SELECT round(quantile_cont(cof_score, 0.75), 6) AS p75, round(quantile_cont(cof_score, 0.9), 6) AS p90,
 round(quantile_cont(cof_score, 0.95), 6) AS p95 FROM r""")
def consequence_cutoffs(spark, folder):
    return rounded(K.cof_cutoffs(consequences(spark, folder)), "p75", "p90", "p95")


# Probability per horizon: share of the customer's orders that fell in each window.
POF_SQL = f"""{COF_SQL},
w AS (SELECT asset, count(*) AS n, count(*) FILTER (started >= TIMESTAMP '{CUTOFF}' - INTERVAL 180 DAY) AS n6,
 count(*) FILTER (started >= TIMESTAMP '{CUTOFF}' - INTERVAL 365 DAY) AS n12 FROM h GROUP BY 1),
p AS (SELECT asset, '6M' AS horizon, n6 / n AS pof FROM w UNION ALL SELECT asset, '12M', n12 / n FROM w),
j AS (SELECT p.*, cof_raw, cof_score, avg_outage_minutes, impact_mean, pof * cof_raw AS risk_raw FROM p LEFT JOIN r USING (asset)),
k AS (SELECT *, (rank() OVER (PARTITION BY horizon ORDER BY risk_raw) + (count(*) OVER (PARTITION BY horizon, risk_raw) - 1) / 2)
  / count(*) OVER (PARTITION BY horizon) * 100 AS risk_score,
 rank() OVER (PARTITION BY horizon ORDER BY risk_raw DESC) AS priority_rank FROM j)"""


def ranked_risk(spark, folder):
    assets = asset_table(spark, folder).select(
        "asset", (F.col("events_6m") / F.col("n_events")).alias("p6"), (F.col("events_12m") / F.col("n_events")).alias("p12"))
    pof = K.long_probabilities(assets, "asset", {"6M": "p6", "12M": "p12"})
    base = K.join_risk(pof, consequences(spark, folder), "asset")
    return K.risk(base, "pof", by=["horizon"])


def horizon_12m(spark, folder):
    return ranked_risk(spark, folder).filter("horizon = '12M'")


@register("risk_by_horizon", f"""{POF_SQL}
SELECT asset, horizon, round(pof, 6) AS pof, round(risk_raw, 2) AS risk_raw, round(risk_score, 6) AS risk_score,
 {BAND_SQL.format(s="risk_score")} AS risk_category, priority_rank FROM k""")
def risk_by_horizon(spark, folder):
    out = ranked_risk(spark, folder).select("asset", "horizon", "pof", "risk_raw", "risk_score", "risk_category", "priority_rank")
    return rounded(rounded(out, "pof", "risk_score"), "risk_raw", digits=2)


CAPEX_SQL = f"""{POF_SQL}, x AS (SELECT *, {BAND_SQL.format(s="risk_score")} AS risk_category FROM k WHERE horizon = '12M'),
top AS (SELECT asset, round(risk_score, 6) AS risk_score, priority_rank, risk_category, CASE risk_category
 WHEN 'KRİTİK' THEN 'IMMEDIATE REPLACEMENT' WHEN 'YÜKSEK' THEN 'PRIORITY REPLACEMENT' WHEN 'ORTA' THEN 'PREVENTIVE MAINTENANCE'
 WHEN 'DÜŞÜK' THEN 'ROUTINE MONITORING' END AS recommended_action FROM x ORDER BY priority_rank, asset LIMIT 100)"""


def capex_rows(spark, folder):
    return K.capex(horizon_12m(spark, folder), "asset", 100)


@register("capex_list", f"{CAPEX_SQL} SELECT * FROM top")
def capex_list(spark, folder):
    return rounded(capex_rows(spark, folder).select("asset", "risk_score", "priority_rank", "risk_category",
                                                    "recommended_action"), "risk_score")


@register("capex_actions", f"{CAPEX_SQL} SELECT recommended_action, count(*) AS n FROM top GROUP BY 1")
def capex_actions(spark, folder):
    return K.action_counts(capex_rows(spark, folder))


@register("priority_candidates", f"""{POF_SQL}
SELECT asset, horizon FROM k WHERE risk_score > 90""")
def priority_candidates(spark, folder):
    return K.priority_candidates(ranked_risk(spark, folder)).select("asset", "horizon")


@register("risk_by_class", f"""{POF_SQL}
SELECT c_mktsegment AS class, count(*) AS n, round(avg(risk_score), 6) AS mean FROM k JOIN customer ON c_custkey = asset
WHERE horizon = '12M' GROUP BY 1""")
def risk_by_class(spark, folder):
    c = table(spark, folder, "customer").select(F.col("c_custkey").alias("asset"), F.col("c_mktsegment").alias("class"))
    joined = sets.attach(horizon_12m(spark, folder), c, "asset")
    return rounded(joined.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.avg("risk_score").alias("mean")), "mean")


@register("prediction_summary", f"""{POF_SQL}
SELECT horizon, count(pof) AS n, round(avg(pof), 6) AS mean, count(*) FILTER (pof > 0.4) AS n_high,
 round(count(*) FILTER (pof > 0.4) / count(*) * 100, 6) AS high_pct, round(quantile_cont(pof, 0.5), 6) AS median
FROM p GROUP BY 1""")
def prediction_summary(spark, folder):
    n = F.col("n_events")
    assets = asset_table(spark, folder).select(
        "asset", (F.col("events_6m") / n).alias("p6"), (F.col("events_12m") / n).alias("p12"))
    long = checkpoint(K.long_probabilities(assets, "asset", {"6M": "p6", "12M": "p12"}))
    return rounded(segments.prediction_summary(long, "horizon", "pof", 0.4), "mean", "high_pct", "median")


@register("high_risk_report", f"""{POF_SQL},
s AS (SELECT asset, avg(pof * 100) AS mean_score FROM p GROUP BY 1)
SELECT asset, round(mean_score, 6) AS mean_score FROM s WHERE mean_score > 20""")
def high_risk_report(spark, folder):
    assets = asset_table(spark, folder)
    n = F.col("n_events")
    scores = assets.select("asset", (F.col("events_6m") / n * 100).alias("s6"), (F.col("events_12m") / n * 100).alias("s12"))
    return rounded(clean.above(scores.select("asset", S.row_mean(["s6", "s12"]).alias("mean_score")), "mean_score", 20), "mean_score")


@register("id_audit", f"""
WITH a AS (SELECT DISTINCT c_custkey AS id FROM customer), b AS (SELECT DISTINCT o_custkey AS id FROM orders
 WHERE o_orderdate <= TIMESTAMP '{EARLY}'), s AS (SELECT count(*) AS n_both FROM a JOIN b USING (id)),
n AS (SELECT (SELECT count(*) FROM a) AS n_a, (SELECT count(*) FROM b) AS n_b, n_both FROM s)
SELECT n_a, n_b, n_both, n_a - n_both AS n_only_a, n_b - n_both AS n_only_b, round(n_both / n_a * 100, 6) AS match_pct,
 CASE WHEN n_both / n_a * 100 < 95 THEN 'poor' WHEN n_both / n_a * 100 < 100 THEN 'partial' ELSE 'full' END AS band FROM n""")
def id_audit(spark, folder):
    h = clean.history(table(spark, folder, "orders"), "o_orderdate", EARLY)
    return rounded(sets.id_audit(table(spark, folder, "customer"), h, "c_custkey", "o_custkey"), "match_pct")


@register("id_mapping", f"""
SELECT DISTINCT c_custkey AS asset, c_custkey AS log_id FROM customer JOIN orders ON o_custkey = c_custkey
WHERE o_orderdate <= TIMESTAMP '{EARLY}'""")
def id_mapping(spark, folder):
    h = clean.history(table(spark, folder, "orders"), "o_orderdate", EARLY)
    return sets.id_mapping(table(spark, folder, "customer"), h, "c_custkey", "o_custkey")


@register("assembled_assets", f"""WITH {TARGET_SQL}, x AS (SELECT o_custkey AS asset, min(o_orderdate) AS first_event,
 max(o_orderdate) AS last_event FROM orders GROUP BY 1)
SELECT c_custkey AS asset, target_3M, target_6M, target_12M, first_event, last_event FROM customer
LEFT JOIN t ON t.asset = c_custkey LEFT JOIN x ON x.asset = c_custkey""")
def assembled_assets(spark, folder):
    x = fault_log(spark, folder).groupBy("asset").agg(F.min("started").alias("first_event"), F.max("started").alias("last_event"))
    return sets.assemble(customers(spark, folder), [targets(spark, folder), x], "asset")


@register("attached_features", """
SELECT o_orderkey, o_custkey, c_mktsegment, n_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey
LEFT JOIN nation ON n_nationkey = c_nationkey""")
def attached_features(spark, folder):
    n = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    c = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    o = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return sets.attach(sets.attach(o, c, "o_custkey"), n, "c_nationkey").drop("c_nationkey")


KINDS = {"MACHINERY": 5.0, "BUILDING": 2.0, "AUTOMOBILE": 1.0}

# A log with what cleaning has to remove: repeated outages, rows without an asset and events before the installation.
DIRTY_SQL = f"""WITH {FAULT_SQL.strip()},
dirty AS (SELECT * FROM f UNION ALL SELECT asset, event_id + 1000000000, started, ended, 'repeat', status, impact * 2, install FROM f WHERE event_id % 10 = 0
  UNION ALL SELECT NULL, event_id, started, ended, cause, status, impact, install FROM f WHERE event_id % 50 = 0),
clean AS (SELECT * FROM (SELECT * FROM dirty WHERE asset IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY asset, started ORDER BY event_id) = 1) WHERE NOT coalesce(started < install, false)),
h AS (SELECT *, (epoch_us(ended) - epoch_us(started)) / 60000000 AS minutes FROM clean WHERE started <= TIMESTAMP '{CUTOFF}'),
g AS (SELECT asset, count(*) AS n_events, count(*) FILTER (started >= TIMESTAMP '{CUTOFF}' - INTERVAL 365 DAY) AS n12,
  avg(impact) AS impact_mean, avg(minutes) FILTER (minutes > 0 AND minutes < 6000) AS outage_mean FROM h GROUP BY 1),
m AS (SELECT c_custkey AS asset, c_mktsegment AS kind, coalesce(n12 / n_events, 0) AS pof, coalesce(outage_mean,
   (SELECT quantile_cont(outage_mean, 0.5) FROM g), 120.0) * coalesce(impact_mean, 100.0)
   * CASE c_mktsegment WHEN 'MACHINERY' THEN 5 WHEN 'BUILDING' THEN 2 ELSE 1 END AS cof_raw
  FROM customer LEFT JOIN g ON asset = c_custkey),
k AS (SELECT *, pof * cof_raw AS risk_raw FROM m),
r AS (SELECT *, (rank() OVER (ORDER BY risk_raw) + (count(*) OVER (PARTITION BY risk_raw) - 1) / 2) / count(*) OVER () * 100 AS risk_score,
  rank() OVER (ORDER BY risk_raw DESC) AS priority_rank FROM k),
x AS (SELECT *, {BAND_SQL.format(s="risk_score")} AS risk_category FROM r)"""


@register("end_to_end_risk", f"""{DIRTY_SQL}
SELECT asset, kind, round(pof, 6) AS pof, round(risk_raw, 2) AS risk_raw, round(risk_score, 6) AS risk_score, priority_rank, risk_category,
 CASE risk_category WHEN 'KRİTİK' THEN 'IMMEDIATE REPLACEMENT' WHEN 'YÜKSEK' THEN 'PRIORITY REPLACEMENT'
 WHEN 'ORTA' THEN 'PREVENTIVE MAINTENANCE' WHEN 'DÜŞÜK' THEN 'ROUTINE MONITORING' END AS recommended_action
FROM x ORDER BY priority_rank, asset LIMIT 100""")
def end_to_end_risk(spark, folder):
    f = fault_log(spark, folder)
    again = f.filter("event_id % 10 = 0").withColumns({
        "event_id": F.col("event_id") + 1_000_000_000, "cause": F.lit("repeat"), "impact": F.col("impact") * 2})
    nameless = f.filter("event_id % 50 = 0").withColumn("asset", F.lit(None).cast("bigint"))
    spec = EventSpec(entity="asset", ts="started", tiebreak=("event_id",), end="ended", install="install", cause="cause", means=("impact",))
    kinds = table(spark, folder, "customer").select(F.col("c_custkey").alias("asset"), F.col("c_mktsegment").alias("kind"))
    top = investment_list(f.unionByName(again).unionByName(nameless), kinds, spec, CUTOFF, "impact", "kind", KINDS, longest=6000.0)
    out = top.select("asset", "kind", "pof", "risk_raw", "risk_score", "priority_rank", "risk_category", "recommended_action")
    return rounded(rounded(out, "pof", "risk_score"), "risk_raw", digits=2)
