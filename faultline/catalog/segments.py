"""Segment comparisons, failure rates, crosstabs and audits on the asset table."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.catalog import register, table
from faultline.catalog.assets import CUTOFF, rounded
from faultline.catalog.features import BASE_SQL, described_assets
from faultline.catalog.risks import TARGET_SQL, targets
from faultline.functions import dates as D
from faultline.operators import profile as P, segments as G
from faultline.session import checkpoint


def _segment_sql(key: str) -> str:
    return f"""SELECT '{key}' AS segment, {key} AS value, count(*) AS n, round(avg(age_years), 6) AS mean_age,
 round(avg(events_12m), 6) AS mean_events_12m, round(avg(recurs_90d) * 100, 6) AS recurrence_pct FROM b GROUP BY {key}"""


@register("segment_comparison", f"{BASE_SQL} " + " UNION ALL ".join(_segment_sql(k) for k in ("class", "district", "status")))
def segment_comparison(spark, folder):
    out = G.segment_stats(described_assets(spark, folder), ["class", "district", "status"], {
        "n": F.count(F.lit(1)), "mean_age": F.avg("age_years"), "mean_events_12m": F.avg("events_12m"),
        "recurrence_pct": F.avg("recurs_90d") * 100.0})
    return rounded(out, "mean_age", "mean_events_12m", "recurrence_pct")


@register("failure_rates", f"{BASE_SQL} " + " UNION ALL ".join(
    f"SELECT '{h}' AS horizon, count(*) FILTER ({c} > 0) AS with_failures, count(*) FILTER ({c} = 0) AS without_failures,"
    f" round(count(*) FILTER ({c} > 0) / count(*) * 100, 6) AS failure_rate, round(avg({c}), 6) AS mean, max({c})::DOUBLE AS max,"
    f" quantile_cont({c}, 0.5)::DOUBLE AS median FROM b" for h, c in
    (("3M", "events_3m"), ("6M", "events_6m"), ("12M", "events_12m"), ("Lifetime", "n_events"))))
def failure_rates(spark, folder):
    a = checkpoint(described_assets(spark, folder))
    return rounded(G.failure_rates(a, {"3M": "events_3m", "6M": "events_6m", "12M": "events_12m", "Lifetime": "n_events"}),
                   "failure_rate", "mean")


@register("chronic_versus_normal", f"""{BASE_SQL}, m AS (SELECT avg(n_events) FILTER (recurs_90d = 1) AS f,
 avg(n_events) FILTER (recurs_90d = 0) AS o FROM b)
SELECT round(f, 6) AS flagged_mean, round(o, 6) AS other_mean, round(f / o, 6) AS ratio, round(o - f, 6) AS difference FROM m""")
def chronic_versus_normal(spark, folder):
    return rounded(G.compare_groups(described_assets(spark, folder), "recurs_90d", "n_events"), "flagged_mean", "other_mean",
                   "ratio", "difference")


CROSS_SQL = """ta AS (SELECT p_brand FROM part GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 8),
tb AS (SELECT p_type FROM part GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3),
c AS (SELECT p_brand, p_type, count(*) AS n FROM part WHERE p_brand IN (FROM ta) AND p_type IN (FROM tb) GROUP BY 1, 2)"""


@register("crosstab_shares", f"WITH {CROSS_SQL} SELECT *, round(n / sum(n) OVER (PARTITION BY p_brand) * 100, 6) AS row_pct FROM c")
def crosstab_shares(spark, folder):
    return rounded(G.crosstab_pct(table(spark, folder, "part"), "p_brand", "p_type", 8, 3), "row_pct")


@register("crosstab_wide", """
SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O",
 count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""")
def crosstab_wide(spark, folder):
    c = G.crosstab_pct(table(spark, folder, "orders"), "o_orderpriority", "o_orderstatus", 10, 10)
    return G.crosstab_wide(c, "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@register("rate_by_class", f"""WITH {TARGET_SQL}
SELECT c_mktsegment AS class, count(target_3M) AS n, CAST(sum(target_3M) AS BIGINT) AS failures, round(avg(target_3M) * 100, 6) AS failure_rate,
 sum(target_3M) = 0 AS zero_failures, avg(target_3M) * 100 > 30 AS high_rate, count(target_3M) < 300 AS rare
FROM t JOIN customer ON c_custkey = asset GROUP BY 1""")
def rate_by_class(spark, folder):
    c = table(spark, folder, "customer").select(F.col("c_custkey").alias("asset"), F.col("c_mktsegment").alias("class"))
    return rounded(G.rate_by_class(targets(spark, folder).join(c, "asset"), "class", "target_3M", rare=300), "failure_rate")


@register("samples_needed", f"""WITH {TARGET_SQL}, n AS (SELECT CAST(sum(target_3M) AS BIGINT) AS positives,
 count(*) FILTER (target_3M = 0) AS negatives FROM t)
SELECT *, CASE WHEN positives >= 6 THEN CAST(floor(negatives * 0.4::DOUBLE / (1 - 0.4::DOUBLE)) AS BIGINT) - positives END AS synthetic_needed
FROM n""")
def samples_needed(spark, folder):
    return G.samples_needed(targets(spark, folder), "target_3M", 0.4)


@register("window_availability", " UNION ALL ".join(
    f"SELECT {m} AS months, count(*) AS n_events, count(DISTINCT o_custkey) AS n_assets FROM orders"
    f" WHERE o_orderdate > TIMESTAMP '{CUTOFF}' AND o_orderdate <= TIMESTAMP '{CUTOFF}' + INTERVAL {m} MONTH" for m in (3, 6, 12, 24)))
def window_availability(spark, folder):
    return G.window_availability(table(spark, folder, "orders"), "o_orderdate", "o_custkey", CUTOFF, [3, 6, 12, 24])


@register("events_per_feature", f"WITH {TARGET_SQL} " + " UNION ALL ".join(
    f"SELECT 'target_{h}' AS target, CAST(sum(target_{h}) AS BIGINT) AS positives, round(sum(target_{h}) / 60, 6) AS ratio,"
    f" CASE WHEN sum(target_{h}) / 60 < 5 THEN 'severe' WHEN sum(target_{h}) / 60 < 10 THEN 'high'"
    f" WHEN sum(target_{h}) / 60 < 20 THEN 'moderate' ELSE 'adequate' END AS band FROM t" for h in ("3M", "6M", "12M")))
def events_per_feature(spark, folder):
    return rounded(G.events_per_feature(targets(spark, folder), ["target_3M", "target_6M", "target_12M"], 60), "ratio")


# Age at first event, shortened so that every band holds assets.
TTFF_SQL = f"""{BASE_SQL}, y AS (SELECT class, install, age_years, days_to_first // 4 AS d, days_to_first // 4 / 365.25::DOUBLE AS yr FROM b)"""


def first_failures(spark, folder):
    a = described_assets(spark, folder).withColumn("d", F.floor(F.col("days_to_first") / 4))
    return a.select("asset", "class", "install", "age_years", "d", D.years("d").alias("yr"))


@register("infant_mortality", f"""{TTFF_SQL}
SELECT class, count(*) AS n, count(*) FILTER (d < 365) AS n_infant, count(*) FILTER (yr > 5) AS n_survivors,
 round(count(*) FILTER (d < 365) / count(*) * 100, 6) AS infant_pct, round(count(*) FILTER (yr > 5) / count(*) * 100, 6) AS survivor_pct
FROM y GROUP BY 1""")
def infant_mortality(spark, folder):
    return rounded(G.infant_mortality(first_failures(spark, folder), "class", "d", "yr"), "infant_pct", "survivor_pct")


@register("infant_mortality_by_year", f"""{TTFF_SQL}
SELECT CAST(year(install) AS INTEGER) AS key, count(*) AS n, round(count(*) / (SELECT count(*) FROM y WHERE d < 365) * 100, 6) AS pct
FROM y WHERE d < 365 GROUP BY 1""")
def infant_mortality_by_year(spark, folder):
    return rounded(G.infant_by(first_failures(spark, folder), F.year("install"), "d"), "pct")


@register("leakage_correlation", f"""{BASE_SQL}, {TARGET_SQL}
SELECT f AS feature, round(r, 6) AS r, CASE WHEN abs(r) > 0.5 THEN 'leak' WHEN abs(r) > 0.3 THEN 'watch' ELSE 'fine' END AS band FROM (
 SELECT 'n_events' AS f, corr(n_events, target_6M) AS r FROM b JOIN t USING (asset) UNION ALL
 SELECT 'events_12m', corr(events_12m, target_6M) FROM b JOIN t USING (asset) UNION ALL
 SELECT 'days_since_last', corr(days_since_last, target_6M) FROM b JOIN t USING (asset))""")
def leakage_correlation(spark, folder):
    joined = described_assets(spark, folder).join(targets(spark, folder), "asset")
    return rounded(G.leakage_correlation(joined, "target_6M", ["n_events", "events_12m", "days_since_last"]), "r")


@register("mean_by_group_pair", f"""{BASE_SQL}
SELECT is_multi, round(avg(events_12m), 6) AS mean FROM (SELECT *, CASE WHEN cause_diversity >= 3 THEN 1 ELSE 0 END AS is_multi FROM b)
GROUP BY 1""")
def mean_by_group_pair(spark, folder):
    a = described_assets(spark, folder).withColumn("is_multi", (F.col("cause_diversity") >= 3).cast("int"))
    return rounded(a.groupBy("is_multi").agg(F.avg("events_12m").alias("mean")), "mean")


@register("age_bins", f"""{BASE_SQL}, m AS (SELECT min(age_years) AS lo, max(age_years) AS hi FROM b)
SELECT CAST(least(greatest(ceil((age_years - lo) / ((hi - lo) / 10)), 1), 10) AS INTEGER) AS bin, count(*) AS n,
 round(avg(events_12m), 6) AS mean FROM b, m WHERE age_years IS NOT NULL GROUP BY 1""")
def age_bins(spark, folder):
    return rounded(P.binned_mean(checkpoint(described_assets(spark, folder)), "age_years", "events_12m", 10), "mean")
