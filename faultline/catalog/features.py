"""Engineered features on the asset table (class = market segment of the customer, district = its nation)."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline import config
from faultline.catalog import register, table
from faultline.catalog.assets import ROLLUP_SQL, asset_table, rounded
from faultline.functions import scalars as S
from faultline.plans.asset_table import feature_table

# The dimension carries class text, district and voltage derived from the customer row.
DIM_SQL = """dim AS (SELECT c_custkey AS asset, n_name AS district, c_acctbal * 10 AS volts,
 CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Kesici' WHEN 'BUILDING' THEN 'OG Hat' WHEN 'FURNITURE' THEN 'YG Kablo'
  WHEN 'HOUSEHOLD' THEN 'AG Sigorta' ELSE 'Direk' END AS class
 FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""
BASE_SQL = f"""{ROLLUP_SQL},
{DIM_SQL},
b AS (SELECT *, CASE class WHEN 'Kesici' THEN 30 WHEN 'OG Hat' THEN 35 WHEN 'YG Kablo' THEN 35 WHEN 'AG Sigorta' THEN 25
  ELSE 25 END AS expected_life FROM assets LEFT JOIN dim USING (asset))"""
URBAN = ("BRAZIL", "CANADA", "JAPAN", "NATION_1", "NATION_7")


def dimension(spark, folder):
    c, n = table(spark, folder, "customer"), table(spark, folder, "nation")
    names = {"AUTOMOBILE": "Kesici", "BUILDING": "OG Hat", "FURNITURE": "YG Kablo", "HOUSEHOLD": "AG Sigorta"}
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("asset"), F.col("n_name").alias("district"),
        (F.col("c_acctbal") * 10).alias("volts"),
        F.coalesce(S.lookup("c_mktsegment", names), F.lit("Direk")).alias("class"))


def described_assets(spark, folder):
    return asset_table(spark, folder).join(dimension(spark, folder), "asset", "left")


def features(spark, folder):
    return feature_table(described_assets(spark, folder), "class", district="district", customers="weight_mean",
                         volts="volts")


@register("life_features", f"""{BASE_SQL}
SELECT asset, class, expected_life, round(age_years / expected_life, 6) AS age_ratio,
 CASE WHEN age_years / expected_life <= 0 THEN NULL WHEN age_years / expected_life <= 0.4 THEN 'Low (0-40%)'
  WHEN age_years / expected_life <= 0.7 THEN 'Medium (40-70%)' WHEN age_years / expected_life <= 1 THEN 'High (70-100%)'
  WHEN age_years / expected_life > 1 THEN 'Critical (>100%)' END AS age_risk,
 round(age_years / expected_life * recurs_90d, 6) AS age_ratio_x_recurrence FROM b""")
def life_features(spark, folder):
    return rounded(features(spark, folder).select("asset", "class", "expected_life", "age_ratio", "age_risk",
                                                  "age_ratio_x_recurrence"), "age_ratio", "age_ratio_x_recurrence")


@register("reliability_features", f"""{BASE_SQL},
q AS (SELECT *, CASE WHEN mtbf_days > 0 THEN days_since_last / mtbf_days END AS norm FROM b),
v AS (SELECT *, CASE WHEN mtbf_days IS NOT NULL AND NOT n_events < 4 THEN CASE WHEN mtbf_days > 0 THEN norm ELSE 1.0 END
  END AS trend, CASE WHEN n_events >= 2 THEN CASE WHEN mtbf_lifetime_days IS NOT NULL AND mtbf_observable_days > 0
  THEN abs(mtbf_lifetime_days - mtbf_observable_days) / mtbf_observable_days ELSE 0.0 END END AS variability FROM q)
SELECT asset, round(CASE WHEN mtbf_days > 0 THEN least(100.0, mtbf_days / 365.0 * 100) ELSE 0.0 END, 6) AS reliability_score,
 round(norm, 6) AS time_since_last_norm, round(norm, 6) AS overdue_factor,
 CASE WHEN norm < 0.8 THEN 'not due' WHEN norm < 1.2 THEN 'approaching' WHEN norm >= 1.2 THEN 'overdue' END AS overdue_band,
 CASE WHEN events_3m = 0 THEN 1 ELSE 0 END AS failure_free_3m, round(trend, 6) AS mtbf_trend,
 CASE WHEN trend < 0.8 THEN 'degrading' WHEN trend <= 1.2 THEN 'stable' WHEN trend > 1.2 THEN 'improving' END AS trend_band,
 round(variability, 6) AS mtbf_variability, CASE WHEN variability < 0.3 THEN 'predictable'
  WHEN variability <= 0.7 THEN 'moderate' WHEN variability > 0.7 THEN 'erratic' END AS variability_band,
 round(1.0 / (days_since_last + 1), 9) AS loading_score FROM v""")
def reliability_features(spark, folder):
    f = features(spark, folder)
    out = f.select("asset", "reliability_score", "time_since_last_norm", "overdue_factor",
                   S.overdue_band("overdue_factor").alias("overdue_band"), "failure_free_3m", "mtbf_trend",
                   S.trend_band("mtbf_trend").alias("trend_band"), "mtbf_variability",
                   S.variability_band("mtbf_variability").alias("variability_band"),
                   F.round("loading_score", 9).alias("loading_score"))
    return rounded(out, "reliability_score", "time_since_last_norm", "overdue_factor", "mtbf_trend", "mtbf_variability")


@register("segment_features", f"""{BASE_SQL}
SELECT asset, CASE WHEN volts IS NULL THEN NULL WHEN volts < 1000 THEN 'AG' WHEN volts >= 10000 AND volts < 36000 THEN 'OG'
  WHEN volts >= 36000 THEN 'YG' ELSE 'Bilinmeyen' END AS voltage_class,
 CASE WHEN volts >= 10000 AND volts < 36000 THEN 1 ELSE 0 END AS is_mv, CASE WHEN volts < 1000 THEN 1 ELSE 0 END AS is_lv,
 CASE WHEN volts >= 36000 THEN 1 ELSE 0 END AS is_hv,
 CASE WHEN upper(district) IN {URBAN} THEN 'Kentsel' ELSE 'Kırsal' END AS region_type,
 CASE WHEN month(last_event) IN (12,1,2) THEN 'Kış' WHEN month(last_event) IN (3,4,5) THEN 'İlkbahar'
  WHEN month(last_event) IN (6,7,8) THEN 'Yaz' ELSE 'Sonbahar' END AS last_event_season,
 round(weight_mean * events_12m * 120, 6) AS customer_minutes_annual,
 CASE WHEN weight_mean * events_12m * 120 <= 0 THEN NULL WHEN weight_mean * events_12m * 120 <= 1000 THEN 'Low'
  WHEN weight_mean * events_12m * 120 <= 5000 THEN 'Medium' WHEN weight_mean * events_12m * 120 <= 20000 THEN 'High'
  ELSE 'Critical' END AS impact_category FROM b""")
def segment_features(spark, folder):
    f = features(spark, folder).withColumn("region_type", S.region_type("district", URBAN))
    return rounded(f.select("asset", "voltage_class", "is_mv", "is_lv", "is_hv", "region_type", "last_event_season",
                            "customer_minutes_annual", "impact_category"), "customer_minutes_annual")


@register("cause_features", f"""{BASE_SQL}
SELECT asset, class || '_' || coalesce(cause_mode, 'nan') AS class_cause,
 round(avg(n_events) OVER (PARTITION BY class || '_' || coalesce(cause_mode, 'nan')), 6) AS class_cause_risk,
 CASE WHEN cause_consistency >= 0.8 THEN 1 ELSE 0 END AS single_cause_flag,
 CASE WHEN cause_diversity >= 3 THEN 1 ELSE 0 END AS multi_cause_flag,
 CASE WHEN coalesce(cause_first, 'nan') <> coalesce(cause_last, 'nan') THEN 1 ELSE 0 END AS cause_changed_flag FROM b""")
def cause_features(spark, folder):
    return rounded(features(spark, folder).select("asset", "class_cause", "class_cause_risk", "single_cause_flag",
                                                  "multi_cause_flag", "cause_changed_flag"), "class_cause_risk")


@register("bin_labels", """
WITH x AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice / 5000 END AS v FROM orders)
SELECT o_orderkey, CASE WHEN v <= 0 THEN NULL WHEN v <= 25 THEN 'Low' WHEN v <= 50 THEN 'Medium' WHEN v <= 75 THEN 'High'
  WHEN v <= 100 THEN 'Critical' END AS score_band,
 CASE WHEN v / 100 <= 0 THEN NULL WHEN v / 100 <= 0.3 THEN 'Low' WHEN v / 100 <= 0.5 THEN 'Medium'
  WHEN v / 100 <= 0.7 THEN 'High' WHEN v / 100 <= 1 THEN 'Critical' END AS chronic_band,
 CASE WHEN v < 0 THEN NULL WHEN v <= 5 THEN '0-5 years' WHEN v <= 10 THEN '5-10 years' WHEN v <= 20 THEN '10-20 years'
  WHEN v <= 30 THEN '20-30 years' WHEN v <= 50 THEN '30-50 years' WHEN v <= 1000 THEN '50+ years' END AS age_band,
 CASE WHEN v < 0 THEN NULL WHEN v <= 75 THEN 'DÜŞÜK' WHEN v <= 90 THEN 'ORTA' WHEN v <= 95 THEN 'YÜKSEK'
  WHEN v <= 100 THEN 'KRİTİK' END AS risk_band,
 CASE WHEN v / 100 >= 0.7 THEN 'YÜKSEK' WHEN v / 100 >= 0.4 THEN 'ORTA' ELSE 'DÜŞÜK' END AS survival_band,
 CASE WHEN v / 100 >= 0.5 THEN 1 ELSE 0 END AS over_6m,
 CASE WHEN v <= 10 THEN CASE WHEN v >= 9 THEN 'EXCELLENT' WHEN v >= 7 THEN 'GOOD' WHEN v >= 5 THEN 'FAIR' ELSE 'POOR' END END
  AS rating,
 CASE WHEN v IS NOT NULL THEN greatest(least(round(v / 100 * 100, 2), 100.0), 0.0) END AS score FROM x""")
def bin_labels(spark, folder):
    x = table(spark, folder, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") / 5000).alias("v"))
    p = F.col("v") / 100
    return x.select(
        "o_orderkey", S.cut("v", *config.SCORE_BINS).alias("score_band"),
        S.cut(p, *config.CHRONIC_BINS).alias("chronic_band"),
        S.cut("v", *config.PROFILE_AGE_BINS, include_lowest=True).alias("age_band"),
        S.cut("v", *config.RISK_BINS, include_lowest=True).alias("risk_band"),
        S.threshold_class(p).alias("survival_band"), S.horizon_class(p, config.RISK_THRESHOLDS["6M"]).alias("over_6m"),
        F.when(F.col("v") <= 10, S.quality_rating("v")).alias("rating"), S.risk_score(F.col("v") / 100).alias("score"))


@register("first_failure_bands", f"""{BASE_SQL}
SELECT asset, CASE WHEN years_to_first IS NULL THEN 'Unknown' WHEN years_to_first < 0 THEN 'Invalid (negative)'
 WHEN years_to_first < 1 THEN 'Infant Mortality (<1y)' WHEN years_to_first < 3 THEN 'Early Failure (1-3y)'
 WHEN years_to_first < 5 THEN 'Normal Operation (3-5y)' ELSE 'Survived Burn-in (>5y)' END AS band FROM b""")
def first_failure_bands(spark, folder):
    from faultline.functions.dates import first_failure_band

    return asset_table(spark, folder).select("asset", first_failure_band("years_to_first").alias("band"))


@register("class_groups", """
WITH g AS (SELECT p_partkey, p_type, CASE WHEN contains(upper(p_name), 'BOLT') OR contains(upper(p_name), 'NUT') THEN 'Fastener'
  WHEN contains(upper(p_name), 'GEAR') THEN 'Drive' END AS grp FROM part),
c AS (SELECT p_type, count(*) AS n FROM part GROUP BY 1)
SELECT p_partkey, coalesce(grp, CASE WHEN n >= 320 THEN p_type ELSE 'Other' END) AS class_group
FROM g LEFT JOIN c USING (p_type)""")
def class_groups(spark, folder):
    from faultline.operators.segments import group_classes

    rules = (("Fastener", ("BOLT", "NUT")), ("Drive", ("GEAR",)))
    p = table(spark, folder, "part").select("p_partkey", "p_type", "p_name")
    return group_classes(p, "p_type", rules, 320, "class_group", text="p_name", other="Other").select(
        "p_partkey", "class_group")


@register("imputed_values", """
WITH x AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS v,
 CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS c FROM orders)
SELECT o_orderkey, coalesce(v, (SELECT quantile_cont(v, 0.5) FROM x)) AS by_median, coalesce(v, 0.0) AS by_zero,
 coalesce(c, 'Unknown') AS by_text FROM x""")
def imputed_values(spark, folder):
    from faultline.operators.profile import impute

    x = table(spark, folder, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("by_median"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("by_zero"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("by_text"))
    return impute(x, median=["by_median"], constants={"by_zero": 0.0, "by_text": "Unknown"})


@register("row_means_and_sums", """
WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
 CASE WHEN l_returnflag <> 'A' THEN l_quantity END AS a, CASE WHEN l_linestatus = 'O' THEN l_tax * 3 END AS b FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
 round((coalesce(a, 0) + coalesce(b, 0)) / nullif((a IS NOT NULL)::INT + (b IS NOT NULL)::INT, 0), 6) AS row_mean,
 round(coalesce(a, 0) + coalesce(b, 0), 6) AS row_sum FROM x""")
def row_means_and_sums(spark, folder):
    x = table(spark, folder, "lineitem").withColumns({
        "a": F.when(F.col("l_returnflag") != "A", F.col("l_quantity")),
        "b": F.when(F.col("l_linestatus") == "O", F.col("l_tax") * 3)})
    return x.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                    F.round(S.row_mean(["a", "b"]), 6).alias("row_mean"),
                    F.round(S.row_sum(["a", "b"]), 6).alias("row_sum"))
