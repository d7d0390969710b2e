"""Ingest, date, filter and deduplication queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.catalog import register, table
from faultline.catalog.assets import CUTOFF, FAULT_SQL, days_sql, fault_log, rounded
from faultline.functions import dates as D, scalars as S
from faultline.operators import clean, ordered

LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
             "l_linestatus", "l_shipdate"]
SHIP_SQL = """s AS (SELECT l_orderkey, l_linenumber, l_shipdate, o_orderdate, l_partkey, l_suppkey FROM lineitem
 JOIN orders ON l_orderkey = o_orderkey)"""


def shipments(spark, folder):
    li = table(spark, folder, "lineitem").select(*LINE_KEYS, "l_partkey", "l_suppkey", "l_shipdate")
    o = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


@register("id_coverage", """
WITH x AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS id FROM orders)
SELECT count(*) AS n_rows, count(id) AS n_kept, count(*) - count(id) AS n_dropped, count(DISTINCT id) AS n_entities
FROM x""")
def id_coverage(spark, folder):
    o = table(spark, folder, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("id"))
    return clean.id_coverage(o, "id")


@register("require_id", """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS id FROM orders WHERE o_orderstatus <> 'P'
AND o_custkey IS NOT NULL""")
def require_id(spark, folder):
    o = table(spark, folder, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("id"))
    return clean.require_id(o, "id")


@register("dedup_exact", "SELECT DISTINCT l_returnflag, l_linestatus, l_shipdate, l_quantity FROM lineitem")
def dedup_exact(spark, folder):
    return clean.dedup_exact(table(spark, folder, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_shipdate", "l_quantity"))


@register("dedup_by_key", f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(LINE_KEYS)}
 ORDER BY {', '.join(LINE_REST)}) AS rn FROM lineitem) WHERE rn = 1""")
def dedup_by_key(spark, folder):
    return clean.dedup_by_key(table(spark, folder, "lineitem"), LINE_KEYS, LINE_REST)


@register("removed_duplicates", f"""
SELECT {', '.join(LINE_KEYS + LINE_REST)}, count(*) AS copies FROM
 (SELECT *, row_number() OVER (PARTITION BY {', '.join(LINE_KEYS)} ORDER BY {', '.join(LINE_REST)}) AS rn FROM lineitem)
WHERE rn > 1 GROUP BY ALL""")
def removed_duplicates(spark, folder):
    return clean.removed_duplicates(table(spark, folder, "lineitem"), LINE_KEYS, LINE_REST)


@register("duplicate_split", f"""
WITH d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey) AS rn
 FROM orders) WHERE rn > 1)
SELECT count(*) FILTER (o_orderdate <= TIMESTAMP '{CUTOFF}') AS pre_cutoff,
 count(*) FILTER (o_orderdate > TIMESTAMP '{CUTOFF}') AS post_cutoff,
 count(DISTINCT CASE WHEN o_orderdate > TIMESTAMP '{CUTOFF}' THEN o_custkey END) AS post_cutoff_entities FROM d""")
def duplicate_split(spark, folder):
    o = table(spark, folder, "orders")
    removed = clean.removed_duplicates(o, ["o_custkey", "o_orderdate"], ["o_orderkey"])
    return clean.duplicate_split(removed, "o_orderdate", CUTOFF, "o_custkey")


@register("events_before_install", f"""WITH {SHIP_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, o_orderdate FROM s WHERE l_shipdate < o_orderdate""")
def events_before_install(spark, folder):
    return clean.exclude_before_install(shipments(spark, folder), "l_shipdate", "o_orderdate")[1]


@register("events_after_install", f"""WITH {SHIP_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, o_orderdate FROM s
WHERE NOT coalesce(l_shipdate < o_orderdate, false)""")
def events_after_install(spark, folder):
    return clean.exclude_before_install(shipments(spark, folder), "l_shipdate", "o_orderdate")[0]


@register("negative_duration", f"""WITH {SHIP_SQL}
SELECT count(*) FILTER (l_shipdate < o_orderdate) AS n_negative,
 count(*) FILTER (l_shipdate IS NOT NULL AND o_orderdate IS NOT NULL) AS n_checked FROM s""")
def negative_duration(spark, folder):
    return clean.negative_duration(shipments(spark, folder), "o_orderdate", "l_shipdate")


@register("history_at_cutoff", f"SELECT * FROM orders WHERE o_orderdate <= TIMESTAMP '{CUTOFF}'")
def history_at_cutoff(spark, folder):
    return clean.history(table(spark, folder, "orders"), "o_orderdate", CUTOFF)


@register("future_events", f"SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{CUTOFF}'")
def future_events(spark, folder):
    return clean.future(table(spark, folder, "orders"), "o_orderdate", CUTOFF)


@register("valid_durations", f"""WITH {SHIP_SQL},
m AS (SELECT l_orderkey, l_linenumber, (epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 60000000 AS minutes FROM s)
SELECT * FROM m WHERE minutes > 0 AND minutes < 10080""")
def valid_durations(spark, folder):
    m = shipments(spark, folder).select(*LINE_KEYS, D.duration("o_orderdate", "l_shipdate", "minute").alias("minutes"))
    return clean.valid_duration(m, "minutes", 10080.0)


ASSET_DIM_SQL = """d AS (SELECT CASE WHEN c_acctbal > -500 THEN c_custkey END AS id, c_name, c_mktsegment AS class,
 TIMESTAMP '1990-01-01' + to_days(CAST(c_custkey * 13 % 4200 AS INTEGER)) AS install,
 CASE WHEN c_nationkey > 0 THEN c_nationkey END AS life, c_acctbal FROM customer)"""


def asset_dimension(spark, folder):
    c = table(spark, folder, "customer")
    install = F.date_add(F.lit("1990-01-01").cast("date"), (F.col("c_custkey") * 13 % 4200).cast("int"))
    return c.select(
        F.when(F.col("c_acctbal") > -500, F.col("c_custkey")).alias("id"), "c_name",
        F.col("c_mktsegment").alias("class"), install.cast("timestamp_ntz").alias("install"),
        F.when(F.col("c_nationkey") > 0, F.col("c_nationkey")).alias("life"), "c_acctbal")


@register("admit_healthy", f"""WITH {ASSET_DIM_SQL}
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY install, c_name) AS rn FROM d
 WHERE id IS NOT NULL) WHERE rn = 1 AND install <= TIMESTAMP '{CUTOFF}' AND life > 0""")
def admit_healthy(spark, folder):
    return clean.admit_healthy(asset_dimension(spark, folder), "id", "install", CUTOFF, ["install", "c_name"], "life")


@register("generated_ids", "SELECT c_custkey, c_name FROM customer WHERE contains(c_name, '99')")
def generated_ids(spark, folder):
    return clean.generated_ids(table(spark, folder, "customer").select("c_custkey", "c_name"), "c_name", "99")


@register("cap_at_quantile", """
SELECT * FROM orders WHERE o_totalprice <= (SELECT quantile_cont(o_totalprice, 0.95) FROM orders)""")
def cap_at_quantile(spark, folder):
    return ordered.cap_at_quantile(table(spark, folder, "orders"), "o_totalprice", 0.95)


@register("high_value_filter", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000")
def high_value_filter(spark, folder):
    return clean.above(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 250000.0)


# Dates as text in every accepted shape, plus serials, times and junk.
DATE_TEXT_SQL = """x AS (SELECT o_orderkey, CASE o_orderkey % 13
 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(o_orderdate, '%d-%m-%Y %H:%M:%S')
 WHEN 2 THEN strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d')
 WHEN 4 THEN ' ' || strftime(o_orderdate, '%d-%m-%Y') || ' ' WHEN 5 THEN strftime(o_orderdate, '%d/%m/%Y')
 WHEN 6 THEN strftime(o_orderdate, '%d.%m.%Y %H:%M:%S') WHEN 7 THEN strftime(o_orderdate, '%d.%m.%Y')
 WHEN 8 THEN strftime(o_orderdate, '%m/%d/%Y %H:%M:%S') WHEN 9 THEN strftime(o_orderdate, '%m/%d/%Y')
 WHEN 10 THEN CAST(CAST(epoch(o_orderdate) / 86400 AS INTEGER) + 25569 AS VARCHAR)
 WHEN 11 THEN '12:30' ELSE o_orderpriority END AS txt FROM orders)"""
PARSED_SQL = """coalesce(try_strptime(trim(txt), ['%Y-%m-%d %H:%M:%S', '%d-%m-%Y %H:%M:%S', '%d/%m/%Y %H:%M:%S',
 '%Y-%m-%d', '%d-%m-%Y', '%d/%m/%Y', '%d.%m.%Y %H:%M:%S', '%d.%m.%Y', '%m/%d/%Y %H:%M:%S', '%m/%d/%Y']),
 CASE WHEN TRY_CAST(txt AS DOUBLE) BETWEEN 1 AND 100000
 THEN TIMESTAMP '1899-12-30' + to_days(CAST(TRY_CAST(txt AS DOUBLE) AS INTEGER)) END)"""


def date_text(spark, folder):
    o = table(spark, folder, "orders")
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 13
    shapes = ["yyyy-MM-dd HH:mm:ss", "dd-MM-yyyy HH:mm:ss", "dd/MM/yyyy HH:mm:ss", "yyyy-MM-dd", "' 'dd-MM-yyyy' '",
              "dd/MM/yyyy", "dd.MM.yyyy HH:mm:ss", "dd.MM.yyyy", "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy"]
    text = F.when(k == 10, (F.unix_date(d.cast("date")) + 25569).cast("string")).when(k == 11, F.lit("12:30"))
    for i, shape in enumerate(shapes):
        text = text.when(k == i, F.date_format(d, shape))
    return o.select("o_orderkey", text.otherwise(F.col("o_orderpriority")).alias("txt"))


@register("parse_dates", f"""WITH {DATE_TEXT_SQL} SELECT o_orderkey, txt, {PARSED_SQL} AS parsed,
 regexp_matches(txt, '^\\s*\\d{{1,2}}:\\d{{2}}(:\\d{{2}})?\\s*$') AS time_only FROM x""")
def parse_dates(spark, folder):
    return date_text(spark, folder).withColumns({
        "parsed": D.parse_date("txt").cast("timestamp_ntz"), "time_only": D.is_time_only("txt")})


@register("valid_install_dates", f"""WITH {DATE_TEXT_SQL}, p AS (SELECT o_orderkey, {PARSED_SQL} AS parsed FROM x)
SELECT o_orderkey, CASE WHEN year(parsed) BETWEEN 1996 AND 2001 AND parsed <> TIMESTAMP '1900-01-01'
 AND NOT (hour(parsed) = 0 AND minute(parsed) = 0 AND second(parsed) = 0
 AND parsed >= TIMESTAMP '{CUTOFF}' - INTERVAL 30 DAY) THEN parsed END AS install FROM p""")
def valid_install_dates(spark, folder):
    p = date_text(spark, folder).select("o_orderkey", D.parse_date("txt").alias("parsed"))
    return p.select("o_orderkey", D.valid_date("parsed", 2001, 1996, CUTOFF).cast("timestamp_ntz").alias("install"))


@register("asset_ages", f"""WITH {ASSET_DIM_SQL}, y AS (SELECT id, c_name, install,
 CASE WHEN install < TIMESTAMP '{CUTOFF}' THEN {days_sql("install", f"TIMESTAMP '{CUTOFF}'")} END AS age_days FROM d)
SELECT c_name, age_days, round(age_days / 365.25::DOUBLE, 6) AS age_years,
 CASE WHEN install < TIMESTAMP '{CUTOFF}' THEN 'GRID_CONNECTION' ELSE 'MISSING' END AS age_source,
 CAST(2000 - year(install) AS INTEGER) AS calendar_age,
 CASE WHEN coalesce(age_days / 365.25 > 60, false) THEN 1 ELSE 0 END AS suspicious_age,
 CASE WHEN install IN (TIMESTAMP '1978-01-01', TIMESTAMP '1900-01-01', TIMESTAMP '1970-01-01') THEN 1 ELSE 0 END
 AS default_date FROM y""")
def asset_ages(spark, folder):
    d = asset_dimension(spark, folder).withColumn("age_days", D.asset_age_days("install", CUTOFF))
    d = d.withColumn("age_years", D.years("age_days"))
    out = d.select("c_name", "age_days", "age_years", D.age_source("install", CUTOFF).alias("age_source"),
                   D.age_by_year("install", 2000).alias("calendar_age"),
                   D.suspicious_age_flag("age_years").alias("suspicious_age"),
                   D.default_date_flag("install").alias("default_date"))
    return rounded(out, "age_years")


@register("event_time_flags", f"""WITH {FAULT_SQL.strip()}
SELECT event_id, CAST(month(started) AS INTEGER) AS month,
 CASE WHEN month(started) IN (6,7,8,9) THEN 1 ELSE 0 END AS summer,
 CASE WHEN month(started) IN (12,1,2) THEN 1 ELSE 0 END AS winter,
 CASE WHEN month(started) IN (12,1,2) THEN 'Kış' WHEN month(started) IN (3,4,5) THEN 'İlkbahar'
  WHEN month(started) IN (6,7,8) THEN 'Yaz' ELSE 'Sonbahar' END AS season,
 round((epoch_us(ended) - epoch_us(started)) / 3600000000, 10) AS repair_hours,
 round((epoch_us(ended) - epoch_us(started)) / 60000000, 9) AS minutes,
 CASE WHEN started >= TIMESTAMP '{CUTOFF}' - INTERVAL 90 DAY THEN 1 ELSE 0 END AS last_3m,
 CASE WHEN started >= TIMESTAMP '{CUTOFF}' - INTERVAL 180 DAY THEN 1 ELSE 0 END AS last_6m,
 CASE WHEN started >= TIMESTAMP '{CUTOFF}' - INTERVAL 365 DAY THEN 1 ELSE 0 END AS last_12m FROM f""")
def event_time_flags(spark, folder):
    f = fault_log(spark, folder)
    return f.select(
        "event_id", F.month("started").alias("month"), D.summer_flag("started").alias("summer"),
        D.winter_flag("started").alias("winter"), D.season("started").alias("season"),
        F.round(D.duration("started", "ended", "hour"), 10).alias("repair_hours"),
        F.round(D.duration("started", "ended", "minute"), 9).alias("minutes"),
        D.recency_flag("started", CUTOFF, 90).alias("last_3m"),
        D.recency_flag("started", CUTOFF, 180).alias("last_6m"),
        D.recency_flag("started", CUTOFF, 365).alias("last_12m"))


@register("duration_units", """
WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
 CASE WHEN l_returnflag = 'A' THEN l_returnflag ELSE CAST(l_quantity AS VARCHAR) END AS txt FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, TRY_CAST(txt AS DOUBLE) * 60 AS from_hours,
 TRY_CAST(txt AS DOUBLE) AS from_minutes, TRY_CAST(txt AS DOUBLE) AS number FROM x""")
def duration_units(spark, folder):
    li = table(spark, folder, "lineitem")
    txt = F.when(F.col("l_returnflag") == "A", F.col("l_returnflag")).otherwise(F.col("l_quantity").cast("string"))
    return li.select(*LINE_KEYS, "l_partkey", "l_suppkey", "l_extendedprice",
                     D.duration_minutes(txt, "hour").alias("from_hours"),
                     D.duration_minutes(txt, "minute").alias("from_minutes"), S.to_number(txt).alias("number"))


@register("segment_ratios", """
WITH x AS (SELECT *, CASE WHEN l_returnflag <> 'N' THEN l_quantity END AS urban,
 CASE WHEN l_linestatus = 'O' THEN l_tax * 100 END AS rural,
 CASE WHEN l_discount > 0 THEN l_discount * 400 END AS total FROM lineitem)
SELECT l_orderkey, l_linenumber, l_extendedprice, l_suppkey,
 round(greatest(least((coalesce(urban, 0) + coalesce(rural, 0)) / (coalesce(total, 0) + 1), 1.0), 0.0), 6) AS ratio,
 round(least((coalesce(urban, 0) + coalesce(rural, 0)) / (total + 1) + 0 * total, 1.0 + 0 * total), 6) AS ratio_of_means
FROM x""")
def segment_ratios(spark, folder):
    x = table(spark, folder, "lineitem").withColumns({
        "urban": F.when(F.col("l_returnflag") != "N", F.col("l_quantity")),
        "rural": F.when(F.col("l_linestatus") == "O", F.col("l_tax") * 100),
        "total": F.when(F.col("l_discount") > 0, F.col("l_discount") * 400)})
    return x.select(*LINE_KEYS, "l_extendedprice", "l_suppkey",
                    F.round(S.ratio_plus1(["urban", "rural"], "total"), 6).alias("ratio"),
                    F.round(S.ratio_plus1_of_means(["urban", "rural"], "total"), 6).alias("ratio_of_means"))


@register("class_from_text", """
WITH x AS (SELECT p_partkey, CASE WHEN p_size <= 15 THEN p_type || ' Arızaları' WHEN p_size <= 30 THEN ' ' || p_type || ' Arızası'
 WHEN p_size <= 40 THEN p_type || ' Ariza' ELSE p_type END AS txt FROM part),
e AS (SELECT p_partkey, CASE WHEN contains(txt, 'Arızaları') THEN trim(replace(trim(txt), 'Arızaları', ''))
 WHEN contains(txt, 'Arızası') THEN trim(replace(trim(txt), 'Arızası', ''))
 WHEN contains(txt, 'Ariza') THEN trim(replace(trim(txt), 'Ariza', '')) ELSE trim(txt) END AS class FROM x)
SELECT p_partkey, class, CASE class WHEN 'ECONOMY' THEN 'Standard' WHEN 'PROMO' THEN 'Standard' ELSE class END AS harmonized
FROM e""")
def class_from_text(spark, folder):
    size, t = F.col("p_size"), F.col("p_type")
    txt = (F.when(size <= 15, F.concat(t, F.lit(" Arızaları"))).when(size <= 30, F.concat(F.lit(" "), t, F.lit(" Arızası")))
           .when(size <= 40, F.concat(t, F.lit(" Ariza"))).otherwise(t))
    p = table(spark, folder, "part").select("p_partkey", S.extract_class(txt).alias("class"))
    return p.withColumn("harmonized", S.harmonize("class", {"ECONOMY": "Standard", "PROMO": "Standard"}))


@register("fallback_ids", """
SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_custkey END, o_orderkey) AS id FROM orders""")
def fallback_ids(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", S.coalesce_id(
        [F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")), F.col("o_orderkey")]).alias("id"))


@register("stage_counts", f"""WITH {FAULT_SQL.strip()}, s0 AS (SELECT * FROM f),
s1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY asset, started ORDER BY event_id) AS rn FROM f) WHERE rn = 1),
s2 AS (SELECT * FROM s1 WHERE NOT started < install), s3 AS (SELECT * FROM s2 WHERE started <= TIMESTAMP '{CUTOFF}'),
u AS (SELECT 0 AS step, 'all' AS stage, count(*) AS n_rows, count(DISTINCT asset) AS n_assets FROM s0
 UNION ALL SELECT 1, 'deduplicated', count(*), count(DISTINCT asset) FROM s1
 UNION ALL SELECT 2, 'after install', count(*), count(DISTINCT asset) FROM s2
 UNION ALL SELECT 3, 'history', count(*), count(DISTINCT asset) FROM s3)
SELECT *, round((1 - n_assets / (SELECT n_assets FROM u WHERE step = 0)) * 100, 6) AS lost_pct FROM u""")
def stage_counts(spark, folder):
    stages = [("after install", ~F.coalesce(clean.before_install("started", "install"), F.lit(False))),
              ("history", F.col("started") <= D.moment(CUTOFF))]
    out = clean.stage_counts(fault_log(spark, folder), "asset", ["asset", "started"], ["event_id"], stages)
    return rounded(out, "lost_pct")


@register("excluded_assets", f"""
SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN
 (SELECT o_custkey FROM orders WHERE o_orderdate <= TIMESTAMP '1995-09-25')""")
def excluded_assets(spark, folder):
    o = table(spark, folder, "orders").select("o_custkey", "o_orderdate")
    kept = clean.history(o, "o_orderdate", "1995-09-25 00:00:00")
    return clean.without(o, kept, "o_custkey").select("o_custkey").distinct()
