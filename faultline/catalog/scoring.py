"""Metrics and calibration on scored documents: the score is the share of length, the label the quality mark."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.catalog import register, table
from faultline.catalog.assets import rounded
from faultline.operators import metrics as M

SCORED_SQL = """s AS (SELECT doc_id, lang, quality, (n_chars % 1000) / 1000.0::DOUBLE AS p FROM documents JOIN labels USING (doc_id))"""


def scored(spark, folder):
    d = table(spark, folder, "documents").select("doc_id", "lang", ((F.col("n_chars") % 1000) / 1000.0).alias("p"))
    return d.join(table(spark, folder, "labels").select("doc_id", "quality"), "doc_id")


LINES_SQL = "s AS (SELECT CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS y, l_quantity / 50 AS p FROM lineitem)"


def scored_lines(spark, folder):
    return table(spark, folder, "lineitem").select((F.col("l_returnflag") == "A").cast("int").alias("y"),
                                                   (F.col("l_quantity") / 50).alias("p"))


def _metrics_sql(y: str, by: str = "") -> str:
    part = f"PARTITION BY {by} " if by else ""
    g = f"GROUP BY {by}" if by else ""
    key = f"{by}, " if by else ""
    join = f"JOIN t USING ({by})" if by else ", t"
    return f"""c AS (SELECT {key}p, count(*) FILTER ({y} = 1) AS pos, count(*) FILTER ({y} = 0) AS neg FROM s GROUP BY {key}p),
k AS (SELECT *, sum(pos) OVER ({part}ORDER BY p DESC) AS tp, sum(neg) OVER ({part}ORDER BY p DESC) AS fp,
  sum(neg) OVER ({part}ORDER BY p) - neg AS below, sum(pos) OVER ({f'PARTITION BY {by}' if by else ''}) AS pt,
  sum(neg) OVER ({f'PARTITION BY {by}' if by else ''}) AS nt FROM c),
r AS (SELECT {key}sum(pos * (below + neg / 2)) / nullif(any_value(pt) * any_value(nt), 0) AS auc, sum(pos / nullif(pt, 0) * (tp / (tp + fp))) AS ap
  FROM k {g}),
t AS (SELECT {key}count(*) FILTER (p >= 0.5 AND {y} = 1) AS tp, count(*) FILTER (p >= 0.5 AND {y} = 0) AS fp,
  count(*) FILTER (p < 0.5 AND {y} = 1) AS fn FROM s {g})
SELECT {key}round(auc, 8) AS auc, round(ap, 8) AS average_precision, round(coalesce(tp / nullif(tp + fp, 0), 0), 8) AS precision,
 round(coalesce(tp / nullif(tp + fn, 0), 0), 8) AS recall, round(2 * tp / (2 * tp + fp + fn), 8) AS f1 FROM r {join}"""


FIVE = ("auc", "average_precision", "precision", "recall", "f1")


@register("binary_metrics", f"WITH {SCORED_SQL}, {_metrics_sql('quality')}")
def binary_metrics(spark, folder):
    return rounded(M.binary_metrics(scored(spark, folder), "quality", "p"), *FIVE, digits=8)


@register("binary_metrics_lines", f"WITH {LINES_SQL}, {_metrics_sql('y')}")
def binary_metrics_lines(spark, folder):
    return rounded(M.binary_metrics(scored_lines(spark, folder), "y", "p"), *FIVE, digits=8)


@register("binary_metrics_by_group", f"WITH {SCORED_SQL}, {_metrics_sql('quality', 'lang')}")
def binary_metrics_by_group(spark, folder):
    return rounded(M.binary_metrics(scored(spark, folder), "quality", "p", by=["lang"]), *FIVE, digits=8)


CURVE_SQL = f"""WITH {LINES_SQL}, c AS (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY 1),
k AS (SELECT p, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS pt, sum(neg) OVER () AS nt FROM c
 WINDOW w AS (ORDER BY p DESC))"""


@register("roc_curve", f"""{CURVE_SQL} SELECT p AS threshold, round(fp / nt, 8) AS fpr, round(tp / pt, 8) AS tpr FROM k
UNION ALL SELECT NULL, 0.0, 0.0""")
def roc_curve(spark, folder):
    return rounded(M.roc_points(scored_lines(spark, folder), "y", "p"), "fpr", "tpr", digits=8)


@register("precision_recall_curve", f"""{CURVE_SQL}
SELECT p AS threshold, round(tp / (tp + fp), 8) AS precision, round(tp / pt, 8) AS recall FROM k UNION ALL SELECT NULL, 1.0, 0.0""")
def precision_recall_curve(spark, folder):
    return rounded(M.pr_points(scored_lines(spark, folder), "y", "p"), "precision", "recall", digits=8)


@register("confusion_matrix", f"""WITH {SCORED_SQL}
SELECT quality AS actual, (p >= 0.5)::INT AS predicted, count(*) AS n FROM s GROUP BY 1, 2""")
def confusion_matrix(spark, folder):
    return M.confusion(scored(spark, folder), "quality", "p")


BIN_SQL = "CAST(" + " + ".join(f"(p > {e!r}::DOUBLE)::INT" for e in
                               [0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001, 0.7000000000000001, 0.8, 0.9]) + " AS INTEGER)"


@register("reliability_curve", f"""WITH {SCORED_SQL}
SELECT {BIN_SQL} AS bin, count(*) AS n, round(avg(p), 8) AS mean_predicted, round(avg(quality), 8) AS positive_share
FROM s GROUP BY 1""")
def reliability_curve(spark, folder):
    return rounded(M.reliability(scored(spark, folder), "quality", "p"), "mean_predicted", "positive_share", digits=8)


LONG_SQL = """l AS (SELECT lang AS horizon, quality, p, 'Uncalibrated' AS model FROM s
 UNION ALL SELECT lang, quality, sqrt(p), 'Isotonic' FROM s UNION ALL SELECT lang, quality, p / 2 + 0.4, 'Platt' FROM s)"""
LOSS_SQL = f"""WITH {SCORED_SQL}, {LONG_SQL},
q AS (SELECT *, greatest(least(p, 1 - 2.220446049250313e-16::DOUBLE), 2.220446049250313e-16::DOUBLE) AS c FROM l),
b AS (SELECT horizon, model, {BIN_SQL} AS bin, avg(p) AS mp, avg(quality) AS ps FROM l GROUP BY 1, 2, 3),
e AS (SELECT horizon, model, avg(abs(ps - mp)) AS calibration_error FROM b GROUP BY 1, 2),
m AS (SELECT horizon, model, avg((p - quality) * (p - quality)) AS brier,
  avg(-CASE WHEN quality = 1 THEN ln(c) ELSE ln(1 - c) END) AS log_loss FROM q GROUP BY 1, 2)"""


def long_scores(spark, folder):
    from faultline.operators.sets import union_all

    s = scored(spark, folder)
    p = F.col("p")
    return union_all([s.select(F.col("lang").alias("horizon"), "quality", x.alias("p"), F.lit(m).alias("model"))
                      for m, x in (("Uncalibrated", p), ("Isotonic", F.sqrt(p)), ("Platt", p / 2 + 0.4))])


def calibration_rows(spark, folder):
    return M.calibration_metrics(long_scores(spark, folder), "quality", "p", ["horizon", "model"])


@register("calibration_metrics", f"""{LOSS_SQL}
SELECT horizon, model, round(brier, 8) AS brier, round(log_loss, 8) AS log_loss, round(calibration_error, 8) AS calibration_error
FROM m JOIN e USING (horizon, model)""")
def calibration_metrics(spark, folder):
    return rounded(calibration_rows(spark, folder), "brier", "log_loss", "calibration_error", digits=8)


@register("calibration_improvement", f"""{LOSS_SQL},
w AS (SELECT horizon, max(calibration_error) FILTER (model = 'Uncalibrated') AS u, max(calibration_error) FILTER (model = 'Isotonic') AS i,
 max(calibration_error) FILTER (model = 'Platt') AS p FROM e GROUP BY 1)
SELECT horizon, round(u, 8) AS uncalibrated_error, round(i, 8) AS isotonic_error, round(p, 8) AS platt_error,
 round((u - i) / u * 100, 6) AS isotonic_improvement, round((u - p) / u * 100, 6) AS platt_improvement FROM w""")
def calibration_improvement(spark, folder):
    out = M.calibration_improvement(calibration_rows(spark, folder))
    return rounded(rounded(out, "uncalibrated_error", "isotonic_error", "platt_error", digits=8),
                   "isotonic_improvement", "platt_improvement")


@register("best_calibration", f"{LOSS_SQL} SELECT horizon, first(model ORDER BY calibration_error NULLS LAST, model) AS model FROM e GROUP BY 1")
def best_calibration(spark, folder):
    from faultline.operators.ordered import best_by

    rows = calibration_rows(spark, folder).select("horizon", "model", "calibration_error")
    return best_by(rows, ["horizon"], "calibration_error", largest=False).select("horizon", "model")


@register("model_comparison", f"""WITH {SCORED_SQL}, z AS (SELECT lang AS horizon, 'length' AS model, quality, p FROM s
 UNION ALL SELECT lang, 'reverse', quality, 1 - p FROM s),
c AS (SELECT horizon, model, p, count(*) FILTER (quality = 1) AS pos, count(*) FILTER (quality = 0) AS neg FROM z GROUP BY 1, 2, 3),
k AS (SELECT *, sum(neg) OVER (PARTITION BY horizon, model ORDER BY p) - neg AS below FROM c),
r AS (SELECT horizon, model, sum(pos * (below + neg / 2)) / nullif(sum(pos) * sum(neg), 0) AS auc FROM k GROUP BY 1, 2)
SELECT horizon, model, round(auc, 8) AS auc, model = arg_max(model, (auc, model)) OVER (PARTITION BY horizon) AS is_best FROM r""")
def model_comparison(spark, folder):
    s = scored(spark, folder).withColumnRenamed("lang", "horizon")
    rows = [M.ranking_metrics(s.withColumn("p", x), "quality", "p", ["horizon"]).select("horizon", F.lit(m).alias("model"), "auc")
            for m, x in (("length", F.col("p")), ("reverse", 1 - F.col("p")))]
    return rounded(M.compare_models(rows), "auc", digits=8)
