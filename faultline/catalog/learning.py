"""Models on the asset table, for all horizons. Every query makes the fits it needs, so none depends on what ran before."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from faultline import vocabulary
from faultline.catalog import register, table
from faultline.catalog.assets import asset_table, rounded
from faultline.catalog.risks import TARGET_SQL, targets
from faultline.models import baseline as B, calibrate as C, explain as X, smote as O, training as T
from faultline.operators import metrics as M, sets
from faultline.operators.schema import annotate_importance
from faultline.session import checkpoint

NUMERIC = ["n_events", "days_since_last", "mtbf_days", "repair_hours_mean", "weight_mean", "age_years", "cause_consistency"]
TEXT = ["cause_mode"]
HORIZONS = ("3M", "6M", "12M")
BOOSTED, CATEGORICAL = T.Settings(), T.Settings(family="categorical")
# Of the models that are fitted many times over, for folds and grids.
SHORT = T.Settings(max_iter=20)


def labelled(spark, folder):
    """The asset table with the labels of all horizons, stored once per query."""
    a = asset_table(spark, folder).withColumn("install_year", F.year("install"))
    return checkpoint(a.join(targets(spark, folder), "asset"))


def _split(labels, horizon="6M"):
    """(prepared table, training share, held-out share) of one horizon."""
    return T.prepared_split(labels, "asset", f"target_{horizon}", NUMERIC, TEXT)


def trained(labels, horizon="6M", family="boosted"):
    """The same with the model fitted on the training share."""
    p, train, test = _split(labels, horizon)
    settings = BOOSTED if family == "boosted" else CATEGORICAL
    return p, train, test, T.fit_classifier(train, f"target_{horizon}", settings, "asset")


def side_by_side(spark, make: Callable, items: Sequence) -> list:
    """What ``make`` returns for each item, in their order. Fits are many short jobs in a row, so those that don't need each other share the cluster."""
    with ThreadPool(max(1, len(items))) as pool:
        return pool.map(inheritable_thread_target(spark)(make), items, chunksize=1)


def _metrics(labels, *families):
    def one(item):
        family, h = item
        _, _, test, model = trained(labels, h, family)
        return T.evaluate(model, test, f"target_{h}", h, family)

    return side_by_side(labels.sparkSession, one, [(f, h) for f in families for h in HORIZONS])


@register("class_weight", f"""WITH {TARGET_SQL}
SELECT CAST(sum(target_6M) AS BIGINT) AS positives, count(*) FILTER (target_6M = 0) AS negatives,
 round(count(*) FILTER (target_6M = 0) / sum(target_6M), 9) AS weight FROM t""")
def class_weight(spark, folder):
    return rounded(T.class_weight(targets(spark, folder), "target_6M"), "weight", digits=9)


@register("stratified_split_sizes", f"""WITH {TARGET_SQL}, s AS (SELECT target_6M, c_mktsegment AS class, count(*) AS n
 FROM t JOIN customer ON c_custkey = asset GROUP BY 1, 2)
SELECT target_6M, class, n - CAST(ceil(n * 0.3::DOUBLE) AS BIGINT) AS n_train, CAST(ceil(n * 0.3::DOUBLE) AS BIGINT) AS n_test FROM s""")
def stratified_split_sizes(spark, folder):
    c = table(spark, folder, "customer").select(F.col("c_custkey").alias("asset"), F.col("c_mktsegment").alias("class"))
    df = checkpoint(targets(spark, folder).join(c, "asset"))
    train, test = T.stratified_split(df, "asset", ["target_6M", "class"])
    n = F.count(F.lit(1))
    return train.groupBy("target_6M", "class").agg(n.alias("n_train")).join(
        test.groupBy("target_6M", "class").agg(n.alias("n_test")), ["target_6M", "class"])


@register("standardized_features", """
WITH m AS (SELECT avg(o_totalprice) AS a, stddev_samp(o_totalprice) AS s FROM orders)
SELECT o_orderkey, round((o_totalprice - a) / s, 8) AS z FROM orders, m""")
def standardized_features(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", array_to_vector(F.array("o_totalprice")).alias("features"))
    return T.standardize(o)[1].select("o_orderkey", F.round(vector_to_array("scaled")[0], 8).alias("z"))


@register("failure_model_metrics")
def failure_model_metrics(spark, folder):
    return sets.union_all(_metrics(labelled(spark, folder), "boosted"))


@register("failure_model_families")
def failure_model_families(spark, folder):
    labels = labelled(spark, folder)
    return M.compare_models(_metrics(labels, "boosted", "categorical"))


@register("tuned_failure_model")
def tuned_failure_model(spark, folder):
    _, train, test = _split(labelled(spark, folder))
    s = replace(SHORT, grid={"maxDepth": [3, 4, 5], "stepSize": [0.05, 0.1]})
    return T.evaluate(T.fit_classifier(train, "target_6M", s, "asset"), test, "target_6M", "6M", "tuned")


@register("failure_scores")
def failure_scores(spark, folder):
    p, _, _, model = trained(labelled(spark, folder))
    return T.score(model, p.table, "asset")


@register("feature_importance")
def feature_importance(spark, folder):
    labels = labelled(spark, folder)
    fitted = zip(HORIZONS, side_by_side(spark, lambda h: trained(labels, h), HORIZONS))
    top = T.top_features(sets.union_all([T.importance(model, p.features, spark, h) for h, (p, _, _, model) in fitted]), 5)
    return annotate_importance(top, vocabulary.COLUMN_NAMES)


@register("chronic_model_scores")
def chronic_model_scores(spark, folder):
    model, p, _ = T.fit_chronic(asset_table(spark, folder), "asset", NUMERIC, TEXT, BOOSTED)
    return T.chronic_scores(model, p, "asset")


@register("chronic_high_risk_report")
def chronic_high_risk_report(spark, folder):
    a = checkpoint(asset_table(spark, folder))
    model, p, _ = T.fit_chronic(a, "asset", NUMERIC, TEXT, BOOSTED)
    return T.high_risk_report(T.chronic_scores(model, p, "asset"), "chronic_probability",
                              a.select("asset", "cause_mode"), "asset")


@register("asset_explanations")
def asset_explanations(spark, folder):
    labels = labelled(spark, folder)

    def explained(h):
        p, _, _, model = trained(labels, h)
        return checkpoint(X.explain_top_assets(model, p.table, "asset", p.features, n=100, k=5).withColumn("horizon", F.lit(h)))

    return sets.union_all(side_by_side(spark, explained, HORIZONS))


@register("global_importance")
def global_importance(spark, folder):
    labels = labelled(spark, folder)
    fitted = dict(zip(HORIZONS, side_by_side(spark, lambda h: trained(labels, h), HORIZONS)))
    return X.global_importance({h: (f[0].table, f[3]) for h, f in fitted.items()}, "asset", fitted["6M"][0].features)


def held_out(labels, horizon="6M"):
    p, train, test, model = trained(labels, horizon)
    scored = checkpoint(T.probabilities(model, test).select("asset", F.col(f"target_{horizon}").alias("y"), "probability_1"))
    return p, model, scored


@register("calibrated_model_metrics")
def calibrated_model_metrics(spark, folder):
    rows, labels = [], labelled(spark, folder)
    for h, (_, _, scored) in zip(HORIZONS, side_by_side(spark, lambda h: held_out(labels, h), HORIZONS)):
        fit, check = T.stratified_split(scored, "asset", ["y"], 0.5)
        fit, check = checkpoint(fit), checkpoint(check)
        iso, platt = C.calibrate_isotonic(fit, "y", "probability_1"), C.calibrate_platt(fit, "y", "probability_1")
        for name, out in (("Uncalibrated", check.withColumn("q", F.col("probability_1"))),
                          ("Isotonic", C.apply_isotonic(iso, check, "probability_1", "q")),
                          ("Platt", C.apply_platt(platt, check, "probability_1", "q"))):
            rows.append(out.select("y", F.col("q").alias("probability_1"), F.lit(name).alias("model"), F.lit(h).alias("horizon")))
    return M.calibration_metrics(checkpoint(sets.union_all(rows)), "y", "probability_1", ["horizon", "model"])


@register("calibrated_scores")
def calibrated_scores(spark, folder):
    p, model, scored = held_out(labelled(spark, folder))
    iso = C.calibrate_isotonic(scored, "y", "probability_1")
    everyone = T.probabilities(model, p.table).select("asset", "probability_1")
    return C.score_calibrated(iso, everyone, "asset", "probability_1")


@register("baseline_metrics")
def baseline_metrics(spark, folder):
    rows, labels = [], labelled(spark, folder)
    for h in HORIZONS:
        _, train, test = _split(labels, h)
        for kind in ("logistic", "ridge", "lasso"):
            model = B.fit_baseline(train, f"target_{h}", "asset", kind)
            s = checkpoint(B.baseline_scores(model, test).select(f"target_{h}", "probability_1"))
            rows.append(M.binary_metrics(s, f"target_{h}", "probability_1").select(F.lit(h).alias("horizon"), F.lit(kind).alias("model"), "*"))
    return M.compare_models(rows)


@register("baseline_coefficients")
def baseline_coefficients(spark, folder):
    p, train, _ = _split(labelled(spark, folder))
    return B.coefficients(B.fit_baseline(train, "target_6M", "asset", "logistic"), p.features, spark)


@register("walk_forward")
def walk_forward(spark, folder):
    spans = [tuple(range(a, b)) for a, b in ((1971, 1978), (1978, 1984), (1984, 1990), (1990, 1997))]
    folds = [T.Fold(name, sum(spans[:i], ()), spans[i]) for i, name in enumerate(("first", "second", "third"), 1)]
    return T.walk_forward_summary(T.walk_forward(labelled(spark, folder), "asset", "install_year", HORIZONS, folds, NUMERIC, TEXT, SHORT))


@register("oversampling_comparison")
def oversampling_comparison(spark, folder):
    """Per horizon: AUC with and without synthetic positives, and what follows from the difference."""
    rows, labels = [], labelled(spark, folder)
    for h in HORIZONS:
        label = f"target_{h}"
        _, train, test = _split(labels, h)
        plain = T.fit_classifier(train, label, SHORT, "asset")
        new = O.smote(train, label, "asset").select(array_to_vector("features").alias("features"), F.lit(1).alias(label))
        more = T.fit_classifier(checkpoint(train.select("features", label).unionByName(new)), label, SHORT, "asset")
        auc = [T.evaluate(m, test, label, h, "x").first()["auc"] for m in (plain, more)]
        rows.append((h, auc[0], auc[1], O.recommendation(auc[1], auc[0])))
    return spark.createDataFrame(rows, "horizon string, auc double, auc_oversampled double, recommendation string")


@register("nearest_neighbours", """
WITH v AS (SELECT DISTINCT list_transform(embedding, lambda e: e::DOUBLE) AS x FROM embeddings WHERE label = 1),
r AS (SELECT min(vec_id) AS id, list_transform(embedding, lambda e: e::DOUBLE) AS x FROM embeddings WHERE label = 1 GROUP BY 2),
d AS (SELECT a.id, b.id AS n_id, list_distance(a.x, b.x) AS distance FROM r a JOIN r b ON a.id <> b.id)
SELECT id, n_id, round(distance, 6) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, n_id) AS rn FROM d)
WHERE rn <= 5""")
def nearest_neighbours(spark, folder):
    e = table(spark, folder, "embeddings").filter("label = 1").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("x"))
    near = O.nearest(checkpoint(e), 5, block_rows=500)
    return near.select("id", F.inline("near")).select("id", "n_id", F.round("distance", 6).alias("distance"))


@register("oversampled_rows")
def oversampled_rows(spark, folder):
    e = table(spark, folder, "embeddings").select(
        "vec_id", (F.col("label") == 1).cast("int").alias("y"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    return O.smote(checkpoint(e), "y", "vec_id").select(F.size("features").alias("width"), F.round(F.element_at("features", 1), 9).alias("first"))
