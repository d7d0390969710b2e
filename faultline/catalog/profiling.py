"""Profiles, value counts, coverage, scorecards, distributions and correlations."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.catalog import register, table
from faultline.catalog.assets import CUTOFF, days_sql, rounded
from faultline.catalog.cleaning import DATE_TEXT_SQL, date_text
from faultline.operators import profile as P, sketches
from faultline.session import checkpoint

# Orders with gaps in two columns, so that shares and bands differ.
GAPPY_SQL = """x AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS cust,
 CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS prio, o_orderstatus AS status,
 CASE WHEN o_totalprice > 30000 THEN o_totalprice END AS price, o_orderdate AS placed FROM orders)"""
GAPPY_TYPES = {"o_orderkey": "bigint", "cust": "bigint", "prio": "string", "status": "string", "price": "double"}
PROFILE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{t}' AS data_type, count(*) AS n_rows, count({c}) AS non_null,"
    f" count(*) - count({c}) AS n_null, round((count(*) - count({c})) / count(*) * 100, 2) AS null_pct,"
    f" count(DISTINCT {c}) AS n_distinct FROM x" for c, t in GAPPY_TYPES.items())


def gappy(spark, folder):
    o, status = table(spark, folder, "orders"), F.col("o_orderstatus")
    return o.select("o_orderkey", F.when(status != "P", F.col("o_custkey")).alias("cust"),
                    F.when(status == "F", F.col("o_orderpriority")).alias("prio"), status.alias("status"),
                    F.when(F.col("o_totalprice") > 30000, F.col("o_totalprice")).alias("price"),
                    F.col("o_orderdate").alias("placed"))


@register("column_profile", f"WITH {GAPPY_SQL} {PROFILE_SQL}")
def column_profile(spark, folder):
    return P.profile(gappy(spark, folder).drop("placed"), "exact").drop("sample_value")


@register("column_profile_samples", """
SELECT 'l_returnflag' AS "column", min(l_returnflag) AS sample_value FROM lineitem
UNION ALL SELECT 'l_linestatus', min(l_linestatus) FROM lineitem""")
def column_profile_samples(spark, folder):
    return P.profile(table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus")).select(
        "column", "sample_value")


SKETCHED = ("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")


@register("column_profile_sketched", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS non_null, CASE WHEN count(DISTINCT {c}) <= 500 THEN count(DISTINCT {c}) END AS n_few,"
    f" true AS distinct_close, true AS most_close FROM lineitem" for c in SKETCHED))
def column_profile_sketched(spark, folder):
    """Sketches of the parts of a table, stored and merged, against exact counts: within three percent, few values exactly."""
    li = table(spark, folder, "lineitem").select(*SKETCHED)
    parts = [sketches.sketch(li.where(F.pmod(F.col("l_orderkey"), F.lit(3)) == k)) for k in range(3)]
    merged = sketches.report(sketches.merge(checkpoint(parts[0].unionAll(parts[1]).unionAll(parts[2]))))
    exact = P.value_spread(li).select("column", F.col("n_distinct").alias("d"), F.col("n_most").alias("m"))
    n = F.col("n_distinct")
    return merged.join(exact, "column").select(
        "column", "non_null", F.when(n <= 500, n).alias("n_few"), (F.abs(n - F.col("d")) <= 0.03 * F.col("d")).alias("distinct_close"),
        (F.abs(F.col("n_most") - F.col("m")) <= 0.01 * F.col("non_null")).alias("most_close"))


@register("missing_bands", f"""WITH {GAPPY_SQL}, p AS ({PROFILE_SQL})
SELECT "column", n_null, null_pct, CASE WHEN null_pct > 50 THEN 'critical' WHEN null_pct > 20 THEN 'high'
 WHEN null_pct > 5 THEN 'medium' ELSE 'low' END AS band FROM p WHERE n_null > 0""")
def missing_bands(spark, folder):
    return P.missing_bands(P.profile(gappy(spark, folder).drop("placed")))


@register("completeness", f"""WITH {GAPPY_SQL}, p AS ({PROFILE_SQL})
SELECT round((1 - sum(n_null) / sum(n_rows)) * 100, 6) AS completeness_pct FROM p""")
def completeness(spark, folder):
    return rounded(P.completeness(P.profile(gappy(spark, folder).drop("placed"))), "completeness_pct")


@register("recommendations", f"""WITH {GAPPY_SQL}, p AS ({PROFILE_SQL})
SELECT 'HIGH' AS priority, 'mostly missing' AS kind, "column" AS subject, null_pct AS measure FROM p WHERE null_pct > 50
UNION ALL SELECT 'MEDIUM', 'few events after the cutoff', 'events', count(*)::DOUBLE FROM orders
 WHERE o_orderdate > TIMESTAMP '{CUTOFF}' HAVING count(*) < 1000000000
UNION ALL SELECT 'MEDIUM', 'many text columns', 'columns', count(*)::DOUBLE FROM p WHERE data_type = 'string' HAVING count(*) > 1""")
def recommendations(spark, folder):
    from faultline.operators.clean import future

    after = future(table(spark, folder, "orders"), "o_orderdate", CUTOFF).agg(F.count(F.lit(1)).alias("n"))
    return P.recommendations(P.profile(gappy(spark, folder).drop("placed")), after, 1_000_000_000, 1)


@register("value_counts", """
SELECT l_shipdate::DATE::VARCHAR AS value, count(*) AS n, round(count(*) / (SELECT count(*) FROM lineitem) * 100, 6) AS pct,
 count(*) < 10 AS rare, count(*) / (SELECT count(*) FROM lineitem) > 0.2 AS dominant FROM lineitem GROUP BY 1""")
def value_counts(spark, folder):
    li = table(spark, folder, "lineitem").select(F.col("l_shipdate").cast("date").cast("string").alias("d"))
    return rounded(P.value_counts(li, "d"), "pct")


@register("top_values", """
WITH c AS (SELECT p_brand AS value, count(*) AS n FROM part GROUP BY 1), t AS (SELECT * FROM c ORDER BY n DESC, value LIMIT 15)
SELECT * FROM t UNION ALL SELECT 'Others', (SELECT count(p_brand) FROM part) - sum(n)::BIGINT FROM t""")
def top_values(spark, folder):
    return P.top_values(table(spark, folder, "part"), "p_brand", 15)


@register("class_imbalance", """
WITH c AS (SELECT o_orderstatus AS v, count(*) AS n FROM orders GROUP BY 1), t AS (SELECT sum(n) AS t FROM c)
SELECT count(*) AS n_values, count(*) FILTER (n < 10) AS n_rare, count(*) FILTER (n / t > 0.2) AS n_dominant,
 round((SELECT sum(n) FROM (SELECT n FROM c ORDER BY n DESC, v LIMIT 2)) / any_value(t) * 100, 6) AS top_share_pct FROM c, t""")
def class_imbalance(spark, folder):
    return rounded(P.imbalance(table(spark, folder, "orders"), "o_orderstatus"), "top_share_pct")


@register("coverage_bands", f"""WITH {GAPPY_SQL}, u AS (
 SELECT 'cust' AS "column", count(cust) AS filled, count(*) AS n FROM x UNION ALL SELECT 'prio', count(prio), count(*) FROM x
 UNION ALL SELECT 'price', count(price), count(*) FROM x
 UNION ALL SELECT 'cust+price', count(*) FILTER (cust IS NOT NULL AND price IS NOT NULL), count(*) FROM x)
SELECT "column", filled, round(filled / n * 100, 6) AS pct, CASE WHEN filled / n * 100 > 90 THEN 'high'
 WHEN filled / n * 100 > 70 THEN 'medium' ELSE 'low' END AS band FROM u""")
def coverage_bands(spark, folder):
    return rounded(P.coverage(gappy(spark, folder), ["cust", "prio", "price"], {"cust+price": ["cust", "price"]}), "pct")


@register("temporal_coverage", f"""
SELECT min(ts) AS first, max(ts) AS last, count(ts) AS n, count(*) FILTER (ts <= TIMESTAMP '2024-01-20') AS n_before,
 count(*) FILTER (ts > TIMESTAMP '2024-01-20') AS n_after, {days_sql("min(ts)", "max(ts)")} AS span_days FROM events""")
def temporal_coverage(spark, folder):
    return P.temporal_coverage(table(spark, folder, "events"), "ts", "2024-01-20 00:00:00")


@register("events_per_year", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n,
 round(count(*) / (SELECT count(*) FROM orders) * 100, 6) AS pct FROM orders GROUP BY 1""")
def events_per_year(spark, folder):
    return rounded(P.events_per_year(table(spark, folder, "orders"), "o_orderdate"), "pct")


@register("above_quantile", """
WITH q AS (SELECT quantile_cont(l_extendedprice, 0.75) AS q FROM lineitem)
SELECT count(*) FILTER (l_extendedprice > q) AS n_above, round(avg(l_extendedprice), 4) AS mean,
 round(any_value(q), 6) AS quantile FROM lineitem, q""")
def above_quantile(spark, folder):
    out = P.above_quantile(table(spark, folder, "lineitem"), "l_extendedprice", 0.75)
    return rounded(rounded(out, "mean", digits=4), "quantile")


def _describe_sql(column: str, source: str, by: str = "") -> str:
    key = f"{by}, " if by else ""
    return f"""SELECT {key}'{column}' AS "column", count({column}) AS count, round(avg({column}), 6) AS mean,
 round(stddev_samp({column}), 6) AS std, round(quantile_cont({column}::DOUBLE, 0.0), 6) AS min,
 round(quantile_cont({column}::DOUBLE, 0.25), 6) AS q25, round(quantile_cont({column}::DOUBLE, 0.5), 6) AS median,
 round(quantile_cont({column}::DOUBLE, 0.75), 6) AS q75, round(quantile_cont({column}::DOUBLE, 0.95), 6) AS p95,
 round(quantile_cont({column}::DOUBLE, 1.0), 6) AS max FROM {source} GROUP BY {by or "ALL"}"""


STATS = ("mean", "std", "min", "q25", "median", "q75", "p95", "max")


@register("distribution_summary", " UNION ALL ".join(
    _describe_sql(c, "(SELECT l_quantity, sqrt(l_extendedprice) AS root_price, l_discount FROM lineitem)")
    for c in ("l_quantity", "root_price", "l_discount")))
def distribution_summary(spark, folder):
    li = table(spark, folder, "lineitem").select("l_quantity", F.sqrt("l_extendedprice").alias("root_price"), "l_discount")
    return rounded(P.describe(li, ["l_quantity", "root_price", "l_discount"]), *STATS)


@register("distribution_by_group", " UNION ALL ".join(
    _describe_sql(c, "(SELECT l_returnflag, l_quantity, sqrt(l_extendedprice) AS root_price FROM lineitem)", "l_returnflag")
    for c in ("l_quantity", "root_price")))
def distribution_by_group(spark, folder):
    li = table(spark, folder, "lineitem").select("l_returnflag", "l_quantity", F.sqrt("l_extendedprice").alias("root_price"))
    return rounded(P.describe(li, ["l_quantity", "root_price"], ["l_returnflag"]), *STATS)


@register("linear_trend", """
WITH x AS (SELECT l_quantity, sqrt(l_extendedprice) AS p FROM lineitem),
c AS (SELECT * FROM x WHERE p <= (SELECT quantile_cont(p, 0.95) FROM x))
SELECT count(*) AS n, round(regr_slope(l_quantity, p), 6) AS slope, round(regr_intercept(l_quantity, p), 6) AS intercept,
 round(corr(l_quantity, p), 6) AS r FROM c""")
def linear_trend(spark, folder):
    li = table(spark, folder, "lineitem").select("l_quantity", F.sqrt("l_extendedprice").alias("p"))
    return rounded(P.linear_trend(li, "p", "l_quantity", 0.95), "slope", "intercept", "r")


NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")
CORR_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, corr({a}, {b}) AS r FROM lineitem"
    for i, a in enumerate(NUMERIC) for b in NUMERIC[i + 1:])


@register("correlation_matrix", f"SELECT feature_1, feature_2, round(r, 6) AS r FROM ({CORR_SQL})")
def correlation_matrix(spark, folder):
    return rounded(P.correlations(table(spark, folder, "lineitem"), NUMERIC), "r")


@register("correlated_pairs", f"SELECT feature_1, feature_2, round(r, 6) AS r FROM ({CORR_SQL}) WHERE abs(r) > 0.5")
def correlated_pairs(spark, folder):
    return rounded(P.correlated_pairs(table(spark, folder, "lineitem"), NUMERIC, 0.5), "r")


@register("binned_mean", """
WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
SELECT CAST(least(greatest(ceil((l_extendedprice - lo) / ((hi - lo) / 10)), 1), 10) AS INTEGER) AS bin, count(*) AS n,
 round(avg(l_quantity), 6) AS mean FROM lineitem, b GROUP BY 1""")
def binned_mean(spark, folder):
    return rounded(P.binned_mean(table(spark, folder, "lineitem"), "l_extendedprice", "l_quantity", 10), "mean")


@register("quality_scorecard", f"""WITH {GAPPY_SQL}, d AS (SELECT DISTINCT cust, prio, status, price, placed FROM x),
u AS (SELECT 'id' AS criterion, count(cust) / count(*) * 100 AS value, 90.0 AS lim FROM x
 UNION ALL SELECT 'class', count(status) / count(*) * 100, 80 FROM x
 UNION ALL SELECT 'install date', count(placed) / count(*) * 100, 80 FROM x
 UNION ALL SELECT 'event time', count(placed) / count(*) * 100, 90 FROM x
 UNION ALL SELECT 'customers', count(price) / count(*) * 100, 80 FROM x
 UNION ALL SELECT 'coordinates', count(*) FILTER (cust IS NOT NULL AND price IS NOT NULL) / count(*) * 100, 80 FROM x
 UNION ALL SELECT 'time span', {days_sql("min(placed)", "max(placed)")}, 365 FROM x
 UNION ALL SELECT 'completeness', (count(cust) + count(prio) + count(status) + count(price) + count(placed)) / (count(*) * 5) * 100, 70 FROM x
 UNION ALL SELECT 'no duplicates', (SELECT count(*) FROM d) / count(*) * 100, 95 FROM x
 UNION ALL SELECT 'class variety', count(DISTINCT status), 5 FROM x)
SELECT criterion, round(value, 6) AS value, value > lim AS passed FROM u""")
def quality_scorecard(spark, folder):
    x = gappy(spark, folder).drop("o_orderkey")
    return rounded(P.quality_scorecard(x, "cust", "status", "placed", "placed", "price", ["cust", "price"]), "value")


@register("raw_scorecard", """
WITH x AS (SELECT l_returnflag, l_linestatus, l_quantity, NULL::DOUBLE AS nothing FROM lineitem)
SELECT 'no empty columns' AS criterion, 1.0::DOUBLE AS value, false AS passed
UNION ALL SELECT 'key columns present', 1.0, true
UNION ALL SELECT 'sufficient rows', count(*)::DOUBLE, count(*) >= 100 FROM x
UNION ALL SELECT 'no duplicates', (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM x)))::DOUBLE,
 count(*) = (SELECT count(*) FROM (SELECT DISTINCT * FROM x)) FROM x""")
def raw_scorecard(spark, folder):
    li = table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", F.lit(None).cast("double").alias("nothing"))
    return P.raw_scorecard(li, ["l_returnflag", "l_quantity"])


@register("optional_criteria", f"""WITH {GAPPY_SQL}
SELECT 'brand' AS criterion, round(greatest(count(cust), count(prio)) / count(*) * 100, 6) AS value,
 greatest(count(cust), count(prio)) / count(*) * 100 > 70 AS passed FROM x
UNION ALL SELECT 'rating', round(count(price) / count(*) * 100, 6), count(price) / count(*) * 100 > 80 FROM x""")
def optional_criteria(spark, folder):
    wanted = {"brand": (["cust", "prio"], 70.0), "rating": (["kva", "price"], 80.0), "voltage": (["volts"], 80.0)}
    return rounded(P.optional_criteria(gappy(spark, folder), wanted), "value")


@register("quality_rating", """
WITH x AS (SELECT count(o_custkey) / count(*) * 100 AS a, count(*) AS n FROM orders)
SELECT CAST((a > 90)::INT + (n > 10)::INT AS BIGINT) AS score, CAST(2 AS BIGINT) AS "of",
 CASE WHEN (a > 90)::INT + (n > 10)::INT >= 9 THEN 'EXCELLENT' WHEN (a > 90)::INT + (n > 10)::INT >= 7 THEN 'GOOD'
 WHEN (a > 90)::INT + (n > 10)::INT >= 5 THEN 'FAIR' ELSE 'POOR' END AS rating FROM x""")
def quality_rating(spark, folder):
    card = P.scorecard(table(spark, folder, "orders"), {
        "id": (P.filled_pct("o_custkey"), 90.0, ">"), "rows": (F.count(F.lit(1)), 10.0, ">")})
    return P.rated(card)


@register("time_only_share", f"""WITH {DATE_TEXT_SQL}
SELECT count(*) FILTER (regexp_matches(txt, '^\\s*\\d{{1,2}}:\\d{{2}}(:\\d{{2}})?\\s*$')) AS n_time_only,
 count(*) AS n FROM x""")
def time_only_share(spark, folder):
    from faultline.functions.dates import is_time_only

    return date_text(spark, folder).agg(F.count_if(is_time_only("txt")).alias("n_time_only"), F.count(F.lit(1)).alias("n"))
