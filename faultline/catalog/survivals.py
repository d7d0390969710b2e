"""Survival records, curves, concordance, the hazard model and category aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline import config
from faultline.catalog import register, table
from faultline.catalog.assets import CUTOFF, asset_table, days_sql, fault_log, rounded
from faultline.catalog.risks import EARLY
from faultline.functions import dates as D
from faultline.models.cox import fit_cox, survival_pof
from faultline.operators import clean, segments, survival as V
from faultline.session import checkpoint

INTERVAL_SQL = f"""i0 AS (SELECT o_custkey AS asset, o_orderdate AS observed_at, lead(o_orderdate) OVER w AS nxt,
  row_number() OVER w AS failure_number FROM orders WHERE o_orderdate <= TIMESTAMP '{CUTOFF}'
  WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
i AS (SELECT asset, observed_at, CAST({days_sql("observed_at", f"coalesce(nxt, TIMESTAMP '{CUTOFF}')")} AS INTEGER) AS time_to_event,
  CASE WHEN nxt IS NULL THEN 0 ELSE 1 END AS event_occurred, failure_number FROM i0),
iv AS (SELECT * FROM i WHERE time_to_event > 0)"""


def intervals(spark, folder):
    return V.survival_intervals(fault_log(spark, folder), "asset", "started", CUTOFF)


def classed(spark, folder):
    c = table(spark, folder, "customer").select(F.col("c_custkey").alias("asset"), F.col("c_mktsegment").alias("class"),
                                                "c_acctbal", "c_nationkey")
    return intervals(spark, folder).join(c, "asset")


@register("survival_intervals", f"WITH {INTERVAL_SQL} SELECT * FROM iv")
def survival_intervals(spark, folder):
    return intervals(spark, folder)


@register("survival_intervals_events", f"""
WITH i AS (SELECT user_id, ts AS observed_at, lead(ts) OVER w AS nxt, row_number() OVER w AS failure_number
  FROM events WHERE ts <= TIMESTAMP '2024-01-20' WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
d AS (SELECT user_id, observed_at, CAST({days_sql("observed_at", "coalesce(nxt, TIMESTAMP '2024-01-20')")} AS INTEGER) AS time_to_event,
  CASE WHEN nxt IS NULL THEN 0 ELSE 1 END AS event_occurred, failure_number FROM i)
SELECT * FROM d WHERE time_to_event > 0""")
def survival_intervals_events(spark, folder):
    return V.survival_intervals(table(spark, folder, "events"), "user_id", "ts", "2024-01-20 00:00:00")


@register("censored_healthy", f"""
WITH a AS (SELECT c_custkey AS asset, CASE WHEN c_acctbal > 5000 THEN c_acctbal / 2 END AS age_days,
  CASE WHEN c_acctbal > 0 THEN c_acctbal / 500 END AS age_years FROM customer
  WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate <= TIMESTAMP '{EARLY}')),
d AS (SELECT asset, CAST(trunc(coalesce(age_days, age_years * 365.25::DOUBLE, 1825)) AS INTEGER) AS time_to_event FROM a)
SELECT asset, TIMESTAMP '{EARLY}' - to_days(time_to_event) AS observed_at, time_to_event, 0 AS event_occurred,
 0::BIGINT AS failure_number FROM d WHERE time_to_event > 0""")
def censored_healthy(spark, folder):
    from faultline.operators.clean import history

    a = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("asset"), F.when(F.col("c_acctbal") > 5000, F.col("c_acctbal") / 2).alias("age_days"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") / 500).alias("age_years"))
    h = history(fault_log(spark, folder), "started", EARLY)
    return V.censored_healthy(a, h, "asset", EARLY, "age_days", "age_years")


@register("survival_with_censored", f"""WITH {INTERVAL_SQL}
SELECT event_occurred, failure_number > 0 AS failed, count(*) AS n, CAST(sum(time_to_event) AS BIGINT) AS days FROM
 (SELECT * FROM iv UNION ALL SELECT c_custkey, NULL, 1825, 0, 0 FROM customer
  WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate <= TIMESTAMP '{CUTOFF}')) GROUP BY 1, 2""")
def survival_with_censored(spark, folder):
    from faultline.operators.clean import history

    assets = table(spark, folder, "customer").select(F.col("c_custkey").alias("asset"))
    h = history(fault_log(spark, folder), "started", CUTOFF)
    out = V.add_censored(intervals(spark, folder), V.censored_healthy(assets, h, "asset", CUTOFF))
    return out.groupBy("event_occurred", (F.col("failure_number") > 0).alias("failed")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("time_to_event").alias("days"))


KM_SQL = f"""WITH {INTERVAL_SQL},
x AS (SELECT c_mktsegment AS class, time_to_event AS time, sum(event_occurred) AS d, count(*) AS leaving
  FROM iv JOIN customer ON c_custkey = asset GROUP BY 1, 2),
r AS (SELECT *, sum(leaving) OVER (PARTITION BY class ORDER BY time DESC) AS n FROM x),
s AS (SELECT class, time, CAST(d AS BIGINT) AS events, CAST(n AS BIGINT) AS at_risk,
  CASE WHEN max(CASE WHEN d = n THEN 1 ELSE 0 END) OVER w = 1 THEN 0.0
   ELSE exp(sum(CASE WHEN d < n THEN ln(1 - d / n) ELSE 0 END) OVER w) END AS survival,
  sum(CASE WHEN d < n THEN d / (n * (n - d)) ELSE 0 END) OVER w AS v
  FROM r WINDOW w AS (PARTITION BY class ORDER BY time)),
b AS (SELECT *, CASE WHEN survival > 0 AND survival < 1 THEN survival END AS q FROM s)"""


@register("kaplan_meier", f"""{KM_SQL}
SELECT class, time, events, at_risk, round(survival, 8) AS survival,
 round(coalesce(exp(-exp(ln(-ln(q)) - 1.959963984540054 * sqrt(v) / ln(q))), survival), 6) AS lower,
 round(coalesce(exp(-exp(ln(-ln(q)) + 1.959963984540054 * sqrt(v) / ln(q))), survival), 6) AS upper FROM b""")
def kaplan_meier(spark, folder):
    km = V.kaplan_meier(classed(spark, folder), "time_to_event", "event_occurred", "class")
    return rounded(rounded(km, "survival", digits=8), "lower", "upper")


@register("median_survival", f"""{KM_SQL}
SELECT class, min(CASE WHEN survival <= 0.5 THEN time END) AS median_days FROM s GROUP BY 1""")
def median_survival(spark, folder):
    return V.median_survival(V.kaplan_meier(classed(spark, folder), "time_to_event", "event_occurred", "class"), "class")


@register("concordance_index", f"""WITH {INTERVAL_SQL},
x AS (SELECT 2 * time_to_event + 1 - event_occurred AS k, event_occurred AS e, round(c_acctbal / 100) AS risk
  FROM iv JOIN customer ON c_custkey = asset),
p AS (SELECT count(*) FILTER (b.risk < a.risk) AS c, count(*) FILTER (b.risk = a.risk) AS t, count(*) AS n
  FROM x a JOIN x b ON a.k < b.k WHERE a.e = 1)
SELECT c::DOUBLE AS concordant, t::DOUBLE AS tied, n::DOUBLE AS comparable, round((c + t * 0.5) / n, 9) AS c_index FROM p""")
def concordance_index(spark, folder):
    x = classed(spark, folder).select("time_to_event", "event_occurred", F.round(F.col("c_acctbal") / 100).alias("risk"))
    return rounded(V.concordance(checkpoint(x), "time_to_event", "event_occurred", "risk"), "c_index", digits=9)


COX_FEATURES = ["age_years", "cause_diversity", "repair_hours_mean", "weight_mean"]


def cox_assets(spark, folder):
    """Every asset with its features; what an asset without events in the history cannot have is 0, its age comes from its install date."""
    install = F.date_sub(F.lit("1996-01-01").cast("date"), (F.col("c_custkey") * 7 % 9000).cast("int")).cast("timestamp_ntz")
    every = table(spark, folder, "customer").select(F.col("c_custkey").alias("asset"), F.col("c_mktsegment").alias("class"),
                                                    D.asset_age_days(install, CUTOFF).alias("age_days"))
    known = asset_table(spark, folder).select("asset", *COX_FEATURES[1:])
    features = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in COX_FEATURES[1:]}
    return checkpoint(every.join(known, "asset", "left").withColumns({"age_years": D.years("age_days"), **features}))


def cox_inputs(spark, folder, assets):
    """The records of assets with events, and one censored record of each that never failed, with the features of both."""
    events = clean.history(fault_log(spark, folder), "started", CUTOFF)
    records = V.add_censored(intervals(spark, folder), V.censored_healthy(assets, events, "asset", CUTOFF, "age_days", "age_years"))
    return checkpoint(records.join(assets.drop("age_days"), "asset"))


def cox_fit(spark, folder):
    """(assets, records, model)."""
    assets = cox_assets(spark, folder)
    rows = cox_inputs(spark, folder, assets)
    return assets, rows, fit_cox(rows, "time_to_event", "event_occurred", COX_FEATURES)


@register("cox_coefficients")
def cox_coefficients(spark, folder):
    return cox_fit(spark, folder)[2].coefficients(spark)


@register("cox_fit_check", f"""WITH {INTERVAL_SQL}
SELECT TRUE AS converged, TRUE AS at_optimum, TRUE AS hazard_rises, TRUE AS probabilities_rise, count(*) FILTER (event_occurred = 1) AS n_failures,
 count(*) FILTER (event_occurred = 0) AS n_censored, (SELECT count(*) FROM customer WHERE c_custkey NOT IN
  (SELECT o_custkey FROM orders WHERE o_orderdate <= TIMESTAMP '{CUTOFF}')) AS n_never_failed,
 (SELECT count(*) FROM customer) AS n_predicted FROM iv""")
def cox_fit_check(spark, folder):
    """What must hold of the fit, with the records of each kind and the number of assets that get a probability."""
    assets, rows, model = cox_fit(spark, folder)
    kinds = rows.agg(
        F.count_if(F.col("event_occurred") == 1).alias("n_failures"),
        F.count_if((F.col("event_occurred") == 0) & (F.col("failure_number") > 0)).alias("n_censored"),
        F.count_if(F.col("failure_number") == 0).alias("n_never_failed"))
    pof = [F.col(f"pof_{h}") for h in config.HORIZON_DAYS]
    rise = F.lit(True)
    for a, b in zip(pof, pof[1:]):
        rise = rise & (a <= b)
    predicted = survival_pof(model, assets, "asset").agg(F.count(pof[0]).alias("n_predicted"), F.min(rise).alias("probabilities_rise"))
    facts = {"converged": model.converged, "at_optimum": model.largest_slope() < 1e-6, "hazard_rises": model.monotone()}
    return kinds.withColumns({k: F.lit(v) for k, v in facts.items()}).withColumns(
        {c: predicted.select(c).scalar() for c in predicted.columns})


def cox_predictions(spark, folder):
    assets, _, model = cox_fit(spark, folder)
    return survival_pof(model, assets, "asset")


@register("survival_probabilities")
def survival_probabilities(spark, folder):
    return cox_predictions(spark, folder)


def modelled(spark, folder):
    """The fitted twelve-month probability of every asset with its class and age."""
    assets, _, model = cox_fit(spark, folder)
    pof = survival_pof(model, assets, "asset").select("asset", F.col("pof_12M").alias("pof"))
    return checkpoint(pof.join(assets.select("asset", "class", F.col("age_years").alias("age")), "asset"))


@register("survival_by_class")
def survival_by_class(spark, folder):
    return segments.by_category(modelled(spark, folder), "class", "pof", "age")


@register("survival_outliers")
def survival_outliers(spark, folder):
    return segments.group_outliers(modelled(spark, folder).drop("age"), "class", "pof")


SHARE_SQL = """p AS (SELECT c_mktsegment AS class, o_custkey AS asset, count(*) FILTER (o_totalprice > 300000) / count(*) AS pof,
 avg(sqrt(o_totalprice)) AS age FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)"""


def shares(spark, folder):
    c = table(spark, folder, "customer").select(F.col("c_custkey").alias("asset"), F.col("c_mktsegment").alias("class"))
    s = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("asset")).agg(
        (F.count_if(F.col("o_totalprice") > 300000) / F.count(F.lit(1))).alias("pof"),
        F.avg(F.sqrt("o_totalprice")).alias("age"))
    return checkpoint(s.join(c, "asset"))


@register("probability_by_class", f"""WITH {SHARE_SQL}
SELECT class, round(avg(pof), 6) AS mean, round(stddev_samp(pof), 6) AS std, round(min(pof), 6) AS min, round(max(pof), 6) AS max,
 count(*) AS n, round(avg(age), 6) AS mean_age, round(quantile_cont(pof, 0.5), 6) AS median FROM p GROUP BY 1""")
def probability_by_class(spark, folder):
    return rounded(segments.by_category(shares(spark, folder), "class", "pof", "age"), "mean", "std", "min", "max",
                   "mean_age", "median")


@register("class_outliers", f"""WITH {SHARE_SQL}, s AS (SELECT *, avg(pof) OVER (PARTITION BY class) AS m,
 stddev_samp(pof) OVER (PARTITION BY class) AS sd FROM p)
SELECT class, asset, round(pof, 6) AS pof, round(m, 6) AS expected, round(CASE WHEN m > 0 THEN (pof - m) / m * 100 ELSE 0 END, 5) AS deviation_pct,
 CASE WHEN sd > 0 AND abs(pof - m) > 2 * sd THEN 1 ELSE 0 END AS outlier FROM s""")
def class_outliers(spark, folder):
    out = segments.group_outliers(shares(spark, folder).drop("age"), "class", "pof")
    return rounded(rounded(out, "pof", "expected"), "deviation_pct", digits=5)
