"""Ranks, empirical distributions, top-k and best-row queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.catalog import register, table
from faultline.catalog.assets import rounded
from faultline.operators import ordered, profile


@register("percentile_ranks", """
WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
 rank() OVER (ORDER BY l_quantity) AS rk, count(*) OVER (PARTITION BY l_quantity) AS ties, count(*) OVER () AS n,
 rank() OVER (ORDER BY l_quantity DESC) AS priority FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
 round((rk + (ties - 1) / 2) / n * 100, 6) AS pct, priority FROM r""")
def percentile_ranks(spark, folder):
    li = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                                 "l_extendedprice")
    return rounded(ordered.with_ranks(li, "l_quantity", "pct", "priority"), "pct")


@register("empirical_cdf", """
WITH c AS (SELECT o_totalprice, count(*) AS n FROM orders GROUP BY 1),
s AS (SELECT *, CAST(sum(n) OVER (ORDER BY o_totalprice) AS BIGINT) AS cum_n FROM c)
SELECT o_totalprice, n, cum_n, round(cum_n / (SELECT count(*) FROM orders) * 100, 6) AS cum_pct FROM s""")
def empirical_cdf(spark, folder):
    return rounded(ordered.ecdf(table(spark, folder, "orders"), "o_totalprice"), "cum_pct")


@register("exact_quantiles", """
SELECT o_orderpriority, 'o_totalprice' AS "column", round(quantile_cont(o_totalprice, 0.5), 6) AS median,
 round(quantile_cont(o_totalprice, 0.9), 6) AS p90 FROM orders GROUP BY 1""")
def exact_quantiles(spark, folder):
    return rounded(ordered.quantiles(table(spark, folder, "orders"), ["o_totalprice"], {"median": 0.5, "p90": 0.9},
                                     by=["o_orderpriority"]), "median", "p90")


@register("top_k_overall", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def top_k_overall(spark, folder):
    return ordered.top_k(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"),
                         [F.col("o_totalprice").desc(), "o_orderkey"], 100)


@register("top_k_per_group", """
SELECT o_orderpriority, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority
 ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 5""")
def top_k_per_group(spark, folder):
    o = table(spark, folder, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return ordered.top_k_per(o, ["o_orderpriority"], "o_totalprice", "o_orderkey", 5)


@register("best_per_group", """
SELECT l_suppkey, first(l_partkey ORDER BY l_extendedprice DESC NULLS LAST, l_partkey) AS l_partkey, max(l_extendedprice) AS l_extendedprice FROM lineitem
GROUP BY 1""")
def best_per_group(spark, folder):
    li = table(spark, folder, "lineitem").select("l_suppkey", "l_partkey", "l_extendedprice")
    return ordered.best_by(li, ["l_suppkey"], "l_extendedprice")


@register("sorted_report", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, 1")
def sorted_report(spark, folder):
    return table(spark, folder, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.col("n").desc(), "o_orderpriority")


@register("ranked_list", """
WITH c AS (SELECT p_type, count(*) AS n, round(avg(p_retailprice), 4) AS mean FROM part GROUP BY 1)
SELECT *, CAST(row_number() OVER (ORDER BY mean DESC, p_type) AS INTEGER) AS rank FROM c""")
def ranked_list(spark, folder):
    c = table(spark, folder, "part").groupBy("p_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("p_retailprice"), 4).alias("mean"))
    return profile.rank_rows(c, [F.col("mean").desc(), "p_type"])


@register("preview_rows", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 3")
def preview_rows(spark, folder):
    from faultline.sources.tables import preview

    return preview(table(spark, folder, "orders"), 3, ["o_orderkey"])


@register("sampled_rows")
def sampled_rows(spark, folder):
    from faultline.sources.tables import sample_rows

    return sample_rows(table(spark, folder, "orders"), ["o_orderkey"], 100, 42)
