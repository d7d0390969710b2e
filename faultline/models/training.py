"""Preparing features, splitting, weighting, fitting and scoring classifiers with MLlib."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, functions as F

from faultline import config
from faultline.functions import scalars as S
from faultline.models.preparation import feature_names, fit_preparation, widest_category
from faultline.operators import labels as L, metrics as M
from faultline.operators.ordered import cumulative, top_k_per
from faultline.operators.sets import union_all
from faultline.session import checkpoint


@dataclass
class Prepared:
    """A stored numeric matrix: the table with ``features``, the names in vector order and the fitted preparation."""

    table: DataFrame
    features: list[str]
    model: PipelineModel


def raw_matrix(df: DataFrame, entity: str, numeric: Sequence[str], categorical: Sequence[str] = (),
               carry: Sequence[str] = ()) -> DataFrame:
    """The columns that a preparation reads, stored once."""
    return checkpoint(df.select(entity, *carry, *[F.col(f"`{c}`").cast("double").alias(c) for c in numeric], *categorical))


def prepared_rows(model: PipelineModel, rows: DataFrame, entity: str, names: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    return checkpoint(model.transform(rows).select(entity, *carry, *names, "features"))


def prepare(df: DataFrame, entity: str, numeric: Sequence[str], categorical: Sequence[str] = (),
            carry: Sequence[str] = ()) -> Prepared:
    """Encode text alphabetically, fill missing numbers with the median and assemble the vector, all learnt from ``df``.

    For rows that a model is judged on use ``prepared_split``.
    """
    rows, names = raw_matrix(df, entity, numeric, categorical, carry), feature_names(numeric, categorical)
    model = fit_preparation(rows, numeric, categorical)
    return Prepared(prepared_rows(model, rows, entity, names, carry), names, model)


def prepared_split(df: DataFrame, entity: str, label: str, numeric: Sequence[str], categorical: Sequence[str] = (),
                   carry: Sequence[str] = (), seed: int = 42) -> tuple[Prepared, DataFrame, DataFrame]:
    """(all rows, training share, held-out share): medians and label codes come from the training share alone."""
    kept, names = list(dict.fromkeys([label, *carry])), feature_names(numeric, categorical)
    rows = raw_matrix(df, entity, numeric, categorical, kept)
    train, test = stratified_split(rows, entity, [label], seed=seed)
    marked = checkpoint(train.withColumn("_held_out", F.lit(0)).unionByName(test.withColumn("_held_out", F.lit(1))))
    model = fit_preparation(marked.filter("_held_out = 0"), numeric, categorical)
    table = prepared_rows(model, marked, entity, names, [*kept, "_held_out"])
    shares = [table.filter(F.col("_held_out") == i).drop("_held_out") for i in (0, 1)]
    return Prepared(table.drop("_held_out"), names, model), *shares


def with_hash_order(df: DataFrame, entity: str, strata: Sequence[str], seed: int) -> DataFrame:
    """Add the position of every row in the hash order of its stratum, and the stratum size, without gathering it."""
    marked = df.withColumns({"_stratum": F.to_json(F.struct(*strata)), "_hash": F.xxhash64(F.lit(seed), entity)})
    order = cumulative(marked.select("_stratum", "_hash"), "_hash", by=["_stratum"]).select(
        "_stratum", "_hash", F.col("n_before").alias("_pos"), F.col("n_total").alias("_size"))
    return marked.join(order, ["_stratum", "_hash"]).select(*df.columns, "_pos", "_size")


def stratified_split(df: DataFrame, entity: str, strata: Sequence[str], test_share: float = 0.3,
                     seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test) with the same share of every stratum; the same ids whatever the partitioning."""
    marked = with_hash_order(df, entity, strata, seed)
    in_test = F.col("_pos") < F.ceil(F.col("_size") * test_share)
    return marked.filter(~in_test).drop("_pos", "_size"), marked.filter(in_test).drop("_pos", "_size")


def with_folds(df: DataFrame, entity: str, strata: Sequence[str], folds: int = 3, seed: int = 42) -> DataFrame:
    """Stratified fold number of every row."""
    marked = with_hash_order(df, entity, strata, seed)
    return marked.withColumn("fold", (F.col("_pos") % folds).cast("int")).drop("_pos", "_size")


def class_weight(df: DataFrame, label: str) -> DataFrame:
    pos, neg = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    return df.agg(pos.alias("positives"), neg.alias("negatives")).withColumn(
        "weight", F.coalesce(F.try_divide("negatives", "positives"), F.lit(1.0)))


def weighted(df: DataFrame, label: str, balanced: bool = False) -> DataFrame:
    """Weight column: positives count neg/pos, or both classes half of all rows."""
    counts = class_weight(df, label)
    if balanced:
        half = (F.col("positives") + F.col("negatives")) / 2.0
        w = counts.select(F.struct(F.try_divide(half, "positives").alias("p"), F.try_divide(half, "negatives").alias("n")).alias("w")).scalar()
    else:
        w = counts.select(F.struct(F.col("weight").alias("p"), F.lit(1.0).alias("n")).alias("w")).scalar()
    return df.withColumn("_w", w).withColumn(
        "weight", F.when(F.col(label) == 1, F.col("_w.p")).otherwise(F.col("_w.n"))).drop("_w")


@dataclass
class Settings:
    family: str = "boosted"  # boosted, categorical or forest
    max_iter: int = 100
    depth: int = 4
    step: float = 0.1
    min_rows: int = 3
    subsample: float = 0.8
    seed: int = 42
    grid: Mapping[str, Sequence] = field(default_factory=dict)


def estimator(label: str, s: Settings, bins: int = 32):
    """Trees on the prepared vector, with at least ``bins`` bins."""
    if s.family == "forest":
        return RandomForestClassifier(labelCol=label, featuresCol="features", weightCol="weight", numTrees=s.max_iter,
                                      maxDepth=s.depth, seed=s.seed, subsamplingRate=s.subsample, minInstancesPerNode=s.min_rows, maxBins=bins)
    return GBTClassifier(labelCol=label, featuresCol="features", weightCol="weight", maxIter=s.max_iter, maxDepth=s.depth,
                         stepSize=s.step, minInstancesPerNode=s.min_rows, subsamplingRate=s.subsample, seed=s.seed, maxBins=bins)


def fit_classifier(train: DataFrame, label: str, s: Settings, entity: str) -> PipelineModel:
    """Fit on class-weighted rows; with a grid, the best of a stratified cross-validation by AUC.

    The boosted family reads codes as numbers, the others split the columns that the vector declares as categories by set.
    """
    rows = weighted(train, label, balanced=s.family == "categorical")
    if s.family == "boosted":
        rows = rows.withColumn("features", F.col("features").alias("features", metadata={}))
    tree = estimator(label, s, max(32, widest_category(rows)))
    pipeline = Pipeline(stages=[tree])
    if not s.grid:
        return pipeline.fit(rows)
    return tune(pipeline, {tree.getParam(k): v for k, v in s.grid.items()}, rows, label, entity)


def tune(pipeline, grid: Mapping, rows: DataFrame, label: str, entity: str, raw: str = "rawPrediction", folds: int = 3,
         parallelism: int = 4):
    builder = ParamGridBuilder()
    for param, values in grid.items():
        builder = builder.addGrid(param, list(values))
    evaluator = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw, metricName="areaUnderROC", numBins=0)  # exact
    folded = checkpoint(with_folds(rows, entity, [label], folds))
    cv = CrossValidator(estimator=pipeline, estimatorParamMaps=builder.build(), evaluator=evaluator, numFolds=folds,
                        foldCol="fold", parallelism=parallelism)
    return cv.fit(folded).bestModel


def probabilities(model: PipelineModel, rows: DataFrame, out: str = "probability_1") -> DataFrame:
    scored = model.transform(rows).withColumn(out, vector_to_array("probability")[1])
    return scored.select(*rows.columns, out)


def score(model: PipelineModel, rows: DataFrame, entity: str, carry: Sequence[str] = ()) -> DataFrame:
    """Probability, 0-100 score and class of every asset, highest first."""
    p = probabilities(model, rows, "pof_probability")
    out = p.select(entity, *carry, "pof_probability", S.risk_score("pof_probability").alias("risk_score"))
    return out.withColumn("risk_class", S.cut("risk_score", *config.SCORE_BINS)).orderBy(F.col("risk_score").desc(), entity)


def evaluate(model: PipelineModel, test: DataFrame, label: str, horizon: str, name: str) -> DataFrame:
    p = checkpoint(probabilities(model, test).select(label, "probability_1"))
    return M.binary_metrics(p, label, "probability_1").select(F.lit(horizon).alias("horizon"), F.lit(name).alias("model"), "*")


def importance(model: PipelineModel, features: Sequence[str], spark, horizon: str) -> DataFrame:
    values = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame([(horizon, f, float(v)) for f, v in zip(features, values)],
                                 "horizon string, feature string, importance double")


def top_features(importances: DataFrame, k: int) -> DataFrame:
    return top_k_per(importances, ["horizon"], "importance", "feature", k)


def fit_pof(df: DataFrame, entity: str, horizons: Sequence[str], numeric: Sequence[str], categorical: Sequence[str],
            s: Settings) -> tuple[dict[str, tuple[Prepared, PipelineModel]], DataFrame]:
    """One prepared table and classifier per horizon (labels ``target_<h>``) with its metrics on the held-out share."""
    models, rows = {}, []
    for h in horizons:
        label = f"target_{h}"
        prepared, train, test = prepared_split(df, entity, label, numeric, categorical, seed=s.seed)
        models[h] = prepared, fit_classifier(train, label, s, entity)
        rows.append(evaluate(models[h][1], test, label, h, s.family))
    return models, union_all(rows)


# Columns that restate the chronic label.
CHRONIC_DERIVED = ("recurs_30d", "recurs_90d", "age_ratio_x_recurrence")


def fit_chronic(assets: DataFrame, entity: str, numeric: Sequence[str], categorical: Sequence[str], s: Settings,
                carry: Sequence[str] = ()) -> tuple[PipelineModel, Prepared, DataFrame]:
    """Repeat-failure classifier on the assets that failed, without the columns that restate its label."""
    labelled = L.chronic_target(assets)
    usable = [c for c in numeric if c not in CHRONIC_DERIVED]
    prepared, train, test = prepared_split(labelled, entity, "target_chronic", usable, categorical, carry, s.seed)
    model = fit_classifier(train, "target_chronic", s, entity)
    return model, prepared, evaluate(model, test, "target_chronic", "chronic", s.family)


def chronic_scores(model: PipelineModel, prepared: Prepared, entity: str, carry: Sequence[str] = ()) -> DataFrame:
    p = probabilities(model, prepared.table, "chronic_probability")
    return p.select(entity, *carry, "chronic_probability", F.col("target_chronic").alias("actual"),
                    S.cut("chronic_probability", *config.CHRONIC_BINS).alias("chronic_class"))


def high_risk_report(scores: DataFrame, probability: str, context: DataFrame, entity: str, threshold: float = 0.5) -> DataFrame:
    """Assets above the threshold with their context, joined on the id, highest first."""
    return scores.filter(F.col(probability) > threshold).join(context, entity, "left").orderBy(F.col(probability).desc(), entity)


def standardize(rows: DataFrame, features: str = "features", out: str = "scaled"):
    """(model, scaled rows): zero mean, unit deviation."""
    model = StandardScaler(inputCol=features, outputCol=out, withMean=True, withStd=True).fit(rows)
    return model, model.transform(rows)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def with_preparation(prepared: Prepared, model: PipelineModel) -> PipelineModel:
    """Preparation and classifier as one pipeline on raw rows, to be saved together."""
    return PipelineModel([*prepared.model.stages, *model.stages])


def load_model(path: str, cls=PipelineModel):
    return cls.load(path)


METRIC_SCHEMA = ("horizon string, model string, auc double, average_precision double, precision double, recall double, "
                 "f1 double")


@dataclass(frozen=True)
class Fold:
    name: str
    train_years: tuple[int, ...]
    test_years: tuple[int, ...]


def walk_forward(df: DataFrame, entity: str, year: str, horizons: Sequence[str], folds: Sequence[Fold],
                 numeric: Sequence[str], categorical: Sequence[str], s: Settings, min_train: int = 50, min_test: int = 10, min_train_pos: int = 5, min_test_pos: int = 2) -> DataFrame:
    """Metrics per horizon and fold, features prepared from the training years; folds too small to judge are left out."""
    names, labels = feature_names(numeric, categorical), [f"target_{h}" for h in horizons]
    raw, rows, tables = raw_matrix(df, entity, numeric, categorical, [year, *labels]), [], {}
    for h in horizons:
        label = f"target_{h}"
        positive = F.col(label) == 1
        counts: list[Column] = []
        for i, f in enumerate(folds):
            for tag, years in (("a", f.train_years), ("b", f.test_years)):
                inside = F.col(year).isin(*years)
                counts += [F.count_if(inside).alias(f"{tag}{i}"), F.count_if(inside & positive).alias(f"{tag}{i}p")]
        n = raw.agg(*counts).first()
        for i, f in enumerate(folds):
            enough = (n[f"a{i}"] >= min_train and n[f"b{i}"] >= min_test and n[f"a{i}p"] >= min_train_pos
                      and n[f"b{i}p"] >= min_test_pos and n[f"a{i}p"] < n[f"a{i}"] and n[f"b{i}p"] < n[f"b{i}"])
            if not enough:
                continue
            if f.name not in tables:
                fitted = fit_preparation(raw.filter(F.col(year).isin(*f.train_years)), numeric, categorical)
                tables[f.name] = prepared_rows(fitted, raw, entity, names, [year, *labels])
            model = fit_classifier(tables[f.name].filter(F.col(year).isin(*f.train_years)), label, s, entity)
            rows.append(evaluate(model, tables[f.name].filter(F.col(year).isin(*f.test_years)), label, h, f.name))
    if not rows:
        return df.sparkSession.createDataFrame([], METRIC_SCHEMA)
    return union_all(rows)


def walk_forward_summary(results: DataFrame) -> DataFrame:
    return results.groupBy("horizon").agg(F.count(F.lit(1)).alias("n_folds"), F.avg("auc").alias("mean_auc"),
                                          F.stddev_samp("auc").alias("sd_auc"), F.avg("average_precision").alias("mean_ap"))
