"""Schema reports, validation, encoding and feature selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.catalog import register, table
from faultline.catalog.assets import CUTOFF, ROLLUP_SQL, asset_table
from faultline.catalog.profiling import GAPPY_SQL, GAPPY_TYPES, gappy
from faultline.operators import encode as E, profile as P, schema as N, select as S, sets, validate as V
from faultline.session import checkpoint

# Translations of the columns of the report tables below.
NAMES = {"cust": "Müşteri_No", "prio": "Arıza_Nedeni", "status": "Durum", "price": "Risk_Score", "o_orderkey": "Ekipman_ID"}


@register("column_reference", "WITH " + GAPPY_SQL + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{NAMES[c]}' AS translation, 'Other' AS category, '{t}' AS data_type, count({c}) AS non_null,"
    f" round(count({c}) / count(*) * 100, 1) AS coverage_pct FROM x" for c, t in GAPPY_TYPES.items()))
def column_reference(spark, folder):
    return N.column_reference(P.profile(gappy(spark, folder).drop("placed")), NAMES)


@register("renamed_columns", f"""WITH {GAPPY_SQL}
SELECT o_orderkey AS "Ekipman_ID", cust AS "Müşteri_No", prio AS "Arıza_Nedeni", status AS "Durum", price AS "Risk_Score", placed FROM x""")
def renamed_columns(spark, folder):
    return N.rename(gappy(spark, folder), NAMES)


@register("renamed_back", f"WITH {GAPPY_SQL} SELECT * FROM x")
def renamed_back(spark, folder):
    return N.rename(N.rename(gappy(spark, folder), NAMES), NAMES, inverted=True)


@register("name_categories", f"""WITH {GAPPY_SQL}
SELECT 'Ekipman_ID' AS "column", 'Equipment Metadata' AS category, count(o_orderkey) AS non_null FROM x
UNION ALL SELECT 'Müşteri_No', 'Customer Impact', count(cust) FROM x
UNION ALL SELECT 'Arıza_Nedeni', 'Failure History', count(prio) FROM x
UNION ALL SELECT 'Durum', 'Other', count(status) FROM x UNION ALL SELECT 'Risk_Score', 'Risk Metrics', count(price) FROM x""")
def name_categories(spark, folder):
    report = P.profile(N.rename(gappy(spark, folder).drop("placed"), NAMES))
    return report.select("column", N.category(F.col("column")).alias("category"), "non_null")


LEAK_NAMES = {"cust": "Arıza_Sayısı_3ay", "prio": "Hedef_6Ay", "status": "Durum", "price": "MTBF_Class_Avg",
              "o_orderkey": "Ekipman_Yaşı_12M"}


@register("leakage_by_name", f"""WITH {GAPPY_SQL}
SELECT 'Arıza_Sayısı_3ay' AS "column", 'temporal_window' AS kind, count(DISTINCT cust) AS n_distinct FROM x
UNION ALL SELECT 'Hedef_6Ay', 'temporal_window', count(DISTINCT prio) FROM x
UNION ALL SELECT 'Durum', NULL, count(DISTINCT status) FROM x
UNION ALL SELECT 'MTBF_Class_Avg', 'aggregation', count(DISTINCT price) FROM x
UNION ALL SELECT 'Ekipman_Yaşı_12M', 'safe', count(DISTINCT o_orderkey) FROM x""")
def leakage_by_name(spark, folder):
    report = P.profile(N.rename(gappy(spark, folder).drop("placed"), LEAK_NAMES), "exact")
    return report.select("column", N.leakage(F.col("column")).alias("kind"), "n_distinct")


@register("low_cardinality_columns", f"""WITH {GAPPY_SQL}
SELECT 'prio' AS "column", 'string' AS data_type, count(DISTINCT prio) AS n_distinct FROM x
UNION ALL SELECT 'status', 'string', count(DISTINCT status) FROM x""")
def low_cardinality_columns(spark, folder):
    return N.low_cardinality(P.profile(gappy(spark, folder).drop("placed"), "sketch"))


@register("columns_by_type", """
SELECT sum(l_quantity + l_extendedprice + l_discount + l_tax + l_linenumber)::BIGINT AS numeric_total,
 count(DISTINCT l_returnflag || l_linestatus) AS n_categories FROM lineitem""")
def columns_by_type(spark, folder):
    li = table(spark, folder, "lineitem").drop("l_orderkey", "l_partkey", "l_suppkey")
    kinds = N.columns_by_type(li)
    total = sum((F.col(c) for c in kinds["numeric"]), F.lit(0.0))
    return li.agg(F.round(F.sum(total)).cast("bigint").alias("numeric_total"),
                  F.count_distinct(F.concat(*kinds["categorical"])).alias("n_categories"))


@register("aligned_columns", """
SELECT o_orderkey, o_custkey, NULL::VARCHAR AS o_orderstatus, o_totalprice, NULL::TIMESTAMP AS o_orderdate, 'none' AS o_orderpriority
FROM orders""")
def aligned_columns(spark, folder):
    o = table(spark, folder, "orders")
    return sets.align(o.select("o_totalprice", "o_orderkey", "o_custkey"), o, {"o_orderpriority": "none"})


@register("resolved_column", "SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def resolved_column(spark, folder):
    o = table(spark, folder, "orders")
    name = N.resolve_column(o.columns, ["state", "Status"], keywords=["orderstatus"])
    return o.groupBy(F.col(name).alias("status")).agg(F.count(F.lit(1)).alias("n"))


@register("table_rules", f"""WITH {GAPPY_SQL}, n AS (SELECT count(*) AS n, count(*) - count(cust) AS nc FROM x)
SELECT 'min_rows' AS "check", CASE WHEN n >= 50 THEN 'pass' ELSE 'fail' END AS status, n::DOUBLE AS value FROM n
UNION ALL SELECT 'max_rows', CASE WHEN n <= 10000 THEN 'pass' ELSE 'fail' END, n::DOUBLE FROM n
UNION ALL SELECT 'min_columns', 'pass', 6 UNION ALL SELECT 'has o_orderkey', 'pass', 1 UNION ALL SELECT 'has cust', 'pass', 1
UNION ALL SELECT 'has Risk_Class', 'fail', 0 UNION ALL SELECT 'no leaking names', 'pass', 0
UNION ALL SELECT 'no nulls in cust', CASE WHEN nc = 0 THEN 'pass' ELSE 'fail' END, nc::DOUBLE FROM n""")
def table_rules(spark, folder):
    rules = V.TableRules(min_rows=50, max_rows=10_000, min_columns=5, required=("o_orderkey", "cust", "Risk_Class"),
                         id_column="o_orderkey", no_leakage=True)
    return V.validate(gappy(spark, folder), rules)


CHECKS = (("negative age", "age_years < 0"), ("3m above 6m", "events_3m > events_6m"), ("6m above 12m", "events_6m > events_12m"),
          ("first failure after age", "years_to_first > age_years"), ("mtbf with one event", "mtbf_days IS NOT NULL AND n_events < 2"),
          ("recurrence with one event", "recurs_90d = 1 AND n_events < 2"), ("negative mtbf", "mtbf_days < 0"),
          ("negative lifetime mtbf", "mtbf_lifetime_days < 0"), ("negative observable mtbf", "mtbf_observable_days < 0"),
          ("negative repair time", "repair_hours_mean < 0"))


@register("integrity_checks", ROLLUP_SQL + " " + " UNION ALL ".join(
    f"SELECT '{n}' AS \"check\", CASE WHEN count(*) FILTER ({c}) = 0 THEN 'pass' ELSE 'fail' END AS status,"
    f" (count(*) FILTER ({c}))::DOUBLE AS value FROM assets" for n, c in CHECKS))
def integrity_checks(spark, folder):
    return V.integrity_checks(asset_table(spark, folder))


@register("post_cutoff_rows", f"""
SELECT 'rows after the cutoff' AS "check", CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END AS status, count(*)::DOUBLE AS value
FROM orders WHERE o_orderdate > TIMESTAMP '{CUTOFF}'""")
def post_cutoff_rows(spark, folder):
    return V.post_cutoff_rows(table(spark, folder, "orders"), "o_orderdate", CUTOFF)


@register("temporal_audit", f"""{ROLLUP_SQL}
SELECT 'failure before installation' AS "check", CASE WHEN count(*) FILTER (first_event < install) = 0 THEN 'pass' ELSE 'fail' END AS status,
 (count(*) FILTER (first_event < install))::DOUBLE AS value FROM assets
UNION ALL SELECT 'last failure after the cutoff', CASE WHEN count(*) FILTER (last_event > TIMESTAMP '{CUTOFF}') = 0 THEN 'pass' ELSE 'fail' END,
 (count(*) FILTER (last_event > TIMESTAMP '{CUTOFF}'))::DOUBLE FROM assets
UNION ALL SELECT 'ages disagree', CASE WHEN count(*) FILTER (abs(age_years - years_to_first) > 1) = 0 THEN 'pass' ELSE 'fail' END,
 (count(*) FILTER (abs(age_years - years_to_first) > 1))::DOUBLE FROM assets""")
def temporal_audit(spark, folder):
    return V.temporal_audit(asset_table(spark, folder), "asset", "install", "first_event", "last_event", CUTOFF,
                            "age_years", "years_to_first")


@register("problem_list", f"""
WITH a AS (SELECT l_suppkey AS id, CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END AS n FROM lineitem),
d AS (SELECT count(*) AS n_rows, count(*) FILTER (n = 0) AS zero, count(*) - count(DISTINCT id) AS dup FROM a),
m AS (SELECT count(DISTINCT id) FILTER (s_suppkey IS NOT NULL AND s_nationkey < 20) / count(DISTINCT id) * 100 AS pct
 FROM a LEFT JOIN supplier ON s_suppkey = id)
SELECT 'asset count' AS "check", CASE WHEN n_rows <= 2000 THEN 'pass' ELSE 'fail' END AS status, n_rows::DOUBLE AS value FROM d
UNION ALL SELECT 'assets without events', CASE WHEN zero = 0 THEN 'pass' ELSE 'fail' END, zero::DOUBLE FROM d
UNION ALL SELECT 'duplicate ids', CASE WHEN dup = 0 THEN 'pass' ELSE 'fail' END, dup::DOUBLE FROM d
UNION ALL SELECT 'id match', CASE WHEN pct >= 95 THEN 'pass' ELSE 'fail' END, round(pct, 6) FROM m""")
def problem_list(spark, folder):
    a = table(spark, folder, "lineitem").select(F.col("l_suppkey").alias("id"), F.when(F.col("l_returnflag") == "N", 0).otherwise(1).alias("n"))
    known = table(spark, folder, "supplier").filter("s_nationkey < 20")
    return V.diagnose(a, "id", "n", sets.id_audit(a, known, "id", "s_suppkey"), 2000)


@register("label_codes", """
WITH x AS (SELECT DISTINCT 'p_brand' AS "column", coalesce(CASE WHEN p_size > 3 THEN p_brand END, 'nan') AS value FROM part
 UNION SELECT DISTINCT 'p_type', p_type FROM part)
SELECT "column", value, row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS code FROM x""")
def label_codes(spark, folder):
    p = table(spark, folder, "part").select(F.when(F.col("p_size") > 3, F.col("p_brand")).alias("p_brand"), "p_type")
    return E.label_codes(p, ["p_brand", "p_type"])


@register("encoded_labels", """
WITH d AS (SELECT v, (row_number() OVER (ORDER BY v) - 1)::DOUBLE AS code FROM (SELECT DISTINCT o_orderpriority AS v FROM orders))
SELECT o_orderkey, o_orderpriority, code AS o_orderpriority_code, v AS decoded FROM orders JOIN d ON v = o_orderpriority""")
def encoded_labels(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    codes = E.label_codes(o, ["o_orderpriority"])
    return E.decode(E.encode(o, ["o_orderpriority"], codes=codes), "o_orderpriority_code", codes, "o_orderpriority", "decoded")


def candidates(spark, folder):
    """A feature table with a constant, a copy, a combination and leaking names among real measures."""
    a = asset_table(spark, folder)
    return checkpoint(a.select(
        "asset", "n_events", "mtbf_days", "mtbf_observable_days", "repair_hours_mean", "weight_mean", "age_years",
        "cause_consistency", "summer_events", F.col("cause_mode"),
        F.lit(7).alias("constant"), (F.col("age_years") * 365.25).alias("age_again"),
        (F.col("repair_hours_mean") + F.col("weight_mean") * 2 + F.col("summer_events")).alias("mixture"),
        F.col("events_3m").alias("Arıza_Sayısı_3ay"), F.col("recurs_90d").alias("Tekrarlayan_Arıza_90gün_Flag")))


CONFIG = S.SelectionConfig(id_column="asset")


@register("constant_columns", f"""{ROLLUP_SQL}
SELECT 'constant' AS feature, 'REMOVED_CONSTANT' AS status, CAST(1 AS INTEGER) AS phase FROM assets HAVING count(DISTINCT 7) <= 1""")
def constant_columns(spark, folder):
    df = candidates(spark, folder)
    found = S.find_constant(S.column_stats(df, df.columns[1:]), lambda c: False)
    return S.selection_report(spark, found).select("feature", "status", "phase")


@register("near_constant_columns", """
SELECT 'l_discount' AS feature, 'REMOVED_NEAR_CONSTANT' AS status FROM lineitem HAVING var_samp(l_discount) < 0.001
UNION ALL SELECT 'l_tax', 'REMOVED_NEAR_CONSTANT' FROM lineitem HAVING var_samp(l_tax) < 0.001
UNION ALL SELECT 'l_quantity', 'REMOVED_NEAR_CONSTANT' FROM lineitem
 HAVING var_samp(l_quantity) < 0.001 OR count(*) FILTER (l_quantity = (SELECT mode(l_quantity) FROM lineitem)) / count(l_quantity) > 0.99""")
def near_constant_columns(spark, folder):
    li = table(spark, folder, "lineitem").select("l_discount", "l_tax", "l_quantity", "l_returnflag")
    found = S.find_near_constant(S.column_stats(li, li.columns), CONFIG, lambda c: False)
    return S.selection_report(spark, found).select("feature", "status")


@register("correlated_columns", f"""{ROLLUP_SQL}
SELECT 'age_again' AS feature, 'REMOVED_HIGH_CORRELATION' AS status FROM assets HAVING abs(corr(age_years, age_years * 365.25)) > 0.85""")
def correlated_columns(spark, folder):
    df = candidates(spark, folder)
    cols = ["age_years", "repair_hours_mean", "summer_events", "age_again"]
    found = S.find_correlated(df, cols, S.column_stats(df, cols), 0.85)
    return S.selection_report(spark, found).select("feature", "status")


# Inverse of a 3 x 3 matrix of cosines by cofactors.
VIF3 = ("l_quantity", "l_extendedprice", "l_tax")


@register("variance_inflation", """
WITH g AS (SELECT sum(l_quantity * l_quantity) AS aa, sum(l_extendedprice * l_extendedprice) AS bb, sum(l_tax * l_tax) AS cc,
 sum(l_quantity * l_extendedprice) AS ab, sum(l_quantity * l_tax) AS ac, sum(l_extendedprice * l_tax) AS bc FROM lineitem),
r AS (SELECT ab / sqrt(aa * bb) AS x, ac / sqrt(aa * cc) AS y, bc / sqrt(bb * cc) AS z FROM g),
d AS (SELECT *, 1 + 2 * x * y * z - x * x - y * y - z * z AS det FROM r)
SELECT 'l_quantity' AS feature, round((1 - z * z) / det, 6) AS vif FROM d
UNION ALL SELECT 'l_extendedprice', round((1 - y * y) / det, 6) FROM d UNION ALL SELECT 'l_tax', round((1 - x * x) / det, 6) FROM d""")
def variance_inflation(spark, folder):
    li = table(spark, folder, "lineitem").select(*VIF3)
    rows = [(c, round(float(v), 6)) for c, v in S.vif_table(li, li.columns).items()]
    return spark.createDataFrame(rows, "feature string, vif double")


@register("variance_inflation_pair", """
WITH g AS (SELECT sum(l_quantity * l_quantity) AS a, sum(l_tax * l_tax) AS b, sum(l_quantity * l_tax) AS c FROM lineitem)
SELECT 'l_quantity' AS feature, round(1 / (1 - c * c / (a * b)), 6) AS vif FROM g
UNION ALL SELECT 'l_tax', round(1 / (1 - c * c / (a * b)), 6) FROM g""")
def variance_inflation_pair(spark, folder):
    li = table(spark, folder, "lineitem").select("l_quantity", "l_tax")
    rows = [(c, round(float(v), 6)) for c, v in S.vif_table(li, li.columns).items()]
    return spark.createDataFrame(rows, "feature string, vif double")


@register("vif_selection")
def vif_selection(spark, folder):
    df = candidates(spark, folder)
    cols = ["repair_hours_mean", "weight_mean", "summer_events", "mixture", "cause_mode"]
    kept, removed = S.vif_select(df, cols, CONFIG)
    return S.selection_report(spark, [*removed, *[S.Decision(c) for c in kept]])


@register("feature_selection_report")
def feature_selection_report(spark, folder):
    return S.selection_report(spark, S.select_features(candidates(spark, folder), CONFIG)[1])


@register("reduced_features")
def reduced_features(spark, folder):
    return S.select_features(candidates(spark, folder), CONFIG)[0]
