"""Reading and writing: typed logs, renamed assets, partitioned tables, side outputs, alternatives, models."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline import vocabulary
from faultline.catalog import register, table
from faultline.catalog.assets import CUTOFF, fault_log
from faultline.catalog.cleaning import DATE_TEXT_SQL, PARSED_SQL, date_text
from faultline.operators import clean, profile as P, schema as N
from faultline.session import scratch_folder
from faultline.sources import tables as R


@register("csv_fault_log", f"""WITH {DATE_TEXT_SQL}
SELECT o_orderkey, {PARSED_SQL} AS txt FROM x""")
def csv_fault_log(spark, folder):
    path = scratch_folder(spark)
    # Ids are written as floats, as a reader that met missing ids would have left them.
    R.write_csv(date_text(spark, folder).withColumn("o_orderkey", F.col("o_orderkey").cast("double")), path)
    log = R.load_fault_log(spark, path, "o_orderkey string, txt string", "csv", id_column="o_orderkey", date_columns=["txt"],
                           options={"header": "true", "ignoreLeadingWhiteSpace": "false"})
    return log.withColumn("txt", F.col("txt").cast("timestamp_ntz"))


@register("parquet_fault_log", f"SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '{CUTOFF}'")
def parquet_fault_log(spark, folder):
    log = R.load_fault_log(spark, f"{folder}/orders.parquet", "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz")
    return clean.future(log, "o_orderdate", CUTOFF)


@register("loaded_assets", "SELECT c_custkey AS asset, c_mktsegment AS asset_class, c_name, c_nationkey, c_acctbal FROM customer")
def loaded_assets(spark, folder):
    return R.load_assets(spark, f"{folder}/customer.parquet", {"c_custkey": "asset", "c_mktsegment": "asset_class"})


@register("monthly_log", """SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2000-03-01'
 AND o_orderdate < TIMESTAMP '2000-05-01'""")
def monthly_log(spark, folder):
    path = scratch_folder(spark)
    R.write_log_by_month(table(spark, folder, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", path)
    return R.read_log_between(spark, path, "o_orderdate", "2000-03-01 00:00:00", "2000-05-01 00:00:00")


@register("rejected_events", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 400000")
def rejected_events(spark, folder):
    path = scratch_folder(spark)
    R.write_split(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), F.col("o_totalprice") > 400000, path)
    return R.read_table(spark, path)


@register("first_available_source", "SELECT o_orderkey, o_totalprice / 500000 AS pof FROM orders")
def first_available_source(spark, folder):
    path = scratch_folder(spark)
    R.write_table(table(spark, folder, "orders").select("o_orderkey", (F.col("o_totalprice") / 500000).alias("pof")), path)
    return R.first_available(spark, [f"{path}-calibrated", f"{path}-survival", path])[1]


@register("vocabulary_check", """
SELECT 'Ekipman_ID' AS "column", 'valid' AS status, 'Ekipman_Özellikleri' AS category, count(o_custkey) AS non_null FROM orders
UNION ALL SELECT 'Risk_Score', 'invalid', 'Diğer', count(o_totalprice) FROM orders
UNION ALL SELECT 'Son_Arıza_Tarihi', 'valid', 'Diğer', count(o_orderdate) FROM orders
UNION ALL SELECT 'o_orderstatus', 'unknown', 'Diğer', count(o_orderstatus) FROM orders""")
def vocabulary_check(spark, folder):
    o = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("Ekipman_ID"), F.col("o_totalprice").alias("Risk_Score"),
        F.col("o_orderdate").alias("Son_Arıza_Tarihi"), "o_orderstatus")
    status = N.classify_names(o.columns, vocabulary.COLUMN_NAMES)
    marks = F.create_map(*[F.lit(x) for kv in status.items() for x in kv])
    category = N.listed_category(F.col("column"), vocabulary.CATEGORY_LISTS, vocabulary.OTHER_CATEGORY)
    return P.profile(o).select("column", marks[F.col("column")].alias("status"), category.alias("category"), "non_null")


@register("display_names", """
SELECT o_custkey AS "Ekipman_ID", min(o_orderdate) AS "İlk_Arıza_Tarihi", max(o_orderdate) AS "Son_Arıza_Tarihi",
 count(*) AS "Toplam_Arıza_Sayısı" FROM orders GROUP BY 1""")
def display_names(spark, folder):
    a = fault_log(spark, folder).groupBy(F.col("asset").alias("Ekipman_ID")).agg(
        F.min("started").alias("Ilk_Ariza_Tarihi"), F.max("started").alias("Son_Arıza_Tarihi"),
        F.count(F.lit(1)).alias("Toplam_Arıza_Sayisi_Lifetime"))
    return N.rename(a, vocabulary.COLUMN_NAMES)


@register("stored_model_scores", """
WITH m AS (SELECT avg(o_totalprice) AS a, stddev_samp(o_totalprice) AS s FROM orders)
SELECT o_orderkey, round((o_totalprice - a) / s, 8) AS z FROM orders, m""")
def stored_model_scores(spark, folder):
    from pyspark.ml.feature import StandardScalerModel
    from pyspark.ml.functions import array_to_vector, vector_to_array

    from faultline.models.training import load_model, save_model, standardize

    path = scratch_folder(spark)
    o = table(spark, folder, "orders").select("o_orderkey", array_to_vector(F.array("o_totalprice")).alias("features"))
    save_model(standardize(o)[0], path)
    loaded = load_model(path, StandardScalerModel)
    return loaded.transform(o).select("o_orderkey", F.round(vector_to_array("scaled")[0], 8).alias("z"))


@register("end_to_end_clean", f"""
WITH f AS (SELECT o_custkey, o_orderdate, min(o_orderkey) AS o_orderkey FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1, 2)
SELECT o_custkey AS asset, count(*) AS n_events FROM f WHERE o_orderdate >= TIMESTAMP '1996-01-01' - to_days(CAST(o_custkey * 7 % 9000 AS INTEGER))
GROUP BY 1""")
def end_to_end_clean(spark, folder):
    from faultline.catalog.assets import FAULT_SPEC
    from faultline.plans.asset_table import clean_events

    kept = clean_events(fault_log(spark, folder), FAULT_SPEC)
    return kept.groupBy("asset").agg(F.count(F.lit(1)).alias("n_events"))
