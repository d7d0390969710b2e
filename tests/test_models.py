import math
import threading
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from faultline.models import calibrate as C, cox, explain as X, smote as O, training as T
from faultline.operators import metrics as M, select as S, survival as V
from faultline.operators.encode import decode, encode, label_codes


@pytest.fixture(scope="module")
def survival(spark):
    rng = np.random.default_rng(0)
    n = 300
    x = rng.normal(size=(n, 2))
    t = np.ceil(rng.exponential(1 / np.exp(x @ [0.8, -0.5])) * 10).astype(int)
    e = (rng.random(n) < 0.7).astype(int)
    rows = [(int(t[i]), int(e[i]), float(x[i, 0]), float(x[i, 1])) for i in range(n)]
    return t, e, x, spark.createDataFrame(rows, "t int, e int, a double, b double").persist()


def penalised(t, e, z, beta, penalty):
    r, total = np.exp(z @ beta), 0.0
    for day in np.unique(t[e == 1]):
        tied = (t == day) & (e == 1)
        d, s, w = tied.sum(), r[t >= day].sum(), r[tied].sum()
        total += (z[tied] @ beta).sum() - sum(math.log(s - k / d * w) for k in range(d))
    return total - 0.5 * penalty * len(t) * beta @ beta


def test_cox_is_at_the_optimum(survival, monkeypatch):
    t, e, x, df = survival
    m = cox.fit_cox(df, "t", "e", ["a", "b"])
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    f = lambda b: penalised(t, e, z, b, 0.1)
    assert m.log_likelihood == pytest.approx(f(m.beta), abs=1e-8)
    step = 1e-4
    for v in np.eye(2):
        assert abs(f(m.beta + step * v) - f(m.beta - step * v)) / (2 * step) < 1e-3
        assert f(m.beta) > f(m.beta + 0.01 * v) and f(m.beta) > f(m.beta - 0.01 * v)
    assert (np.diff(m.baseline_hazard) >= 0).all()
    monkeypatch.setattr(cox, "_DIRECT_TIES", 2)  # the closed form for many ties agrees with the sums
    np.testing.assert_allclose(cox.fit_cox(df, "t", "e", ["a", "b"]).beta, m.beta, rtol=1e-9)


def test_survival_probabilities(spark, survival):
    df = survival[3]
    m = cox.fit_cox(df, "t", "e", ["a", "b"])
    assets = spark.createDataFrame([(1, -1.0, 1.0), (2, 2.0, -1.0), (3, None, 0.0)], "id int, a double, b double")
    p = cox.survival_pof(m, assets, "id", {"3M": 5, "12M": 20}, {"3M": 0.4, "12M": 0.6}).toPandas().set_index("id")
    assert p.pof_3M[2] > p.pof_3M[1] and (p.pof_12M >= p.pof_3M).all()
    assert p.pof_3M[3] == 0.5 and p.risk_class_3M[3] == 0
    none = cox.survival_pof(None, assets, "id", {"12M": 20}, {"12M": 0.4}).first()
    assert none["pof_12M"] == 0.5 and none["risk_class_12M"] == 0 and none["risk_category"] == "ORTA"


def test_concordance_matches_all_pairs(survival):
    t, e, x, df = survival
    risk = np.round(x[:, 0], 1)
    good = tied = total = 0
    for i in range(len(t)):
        for j in range(len(t)):
            if e[i] and (t[i] < t[j] or (t[i] == t[j] and not e[j])):
                total += 1
                good += risk[i] > risk[j]
                tied += risk[i] == risk[j]
    r = V.concordance(df.withColumn("r", F.round("a", 1)), "t", "e", "r").first()
    assert (r["concordant"], r["tied"], r["comparable"]) == (good, tied, total)


def test_concordance_of_long_times(spark):
    rows = [(100, 1, 4.0), (9000, 1, 3.0), (20_000, 1, 2.0), (1_000_000, 0, 1.0), (-5, 1, 9.0)]
    r = V.concordance(spark.createDataFrame(rows, "t long, e int, r double"), "t", "e", "r").first()
    assert (r["comparable"], r["concordant"], r["c_index"]) == (10, 10, 1.0)
    empty = V.concordance(spark.createDataFrame([], "t long, e int, r double"), "t", "e", "r").first()
    assert empty["c_index"] is None


def test_cox_wants_days_and_tells_convergence(spark, survival):
    df = survival[3]
    assert cox.fit_cox(df, "t", "e", ["a", "b"]).converged
    assert not cox.fit_cox(df, "t", "e", ["a", "b"], max_steps=1).converged
    assert cox.fit_cox(df, "t", "e", ["a", "b"], max_steps=1).coefficients(spark).select("converged", "iterations").distinct().collect() == [(False, 1)]
    with pytest.raises(ValueError):
        cox.fit_cox(df.withColumn("t", F.col("t") * 86_400), "t", "e", ["a"])
    with pytest.raises(ValueError):
        cox.fit_cox(df.withColumn("t", F.col("t") / 24.0), "t", "e", ["a"])


def test_kaplan_meier_edges(spark):
    rows = [("a", 1, 1), ("a", 1, 0), ("a", 2, 1), ("a", 3, 1), ("b", 5, 0), ("b", 6, 0)]
    km = V.kaplan_meier(spark.createDataFrame(rows, "c string, t int, e int"), "t", "e", "c").toPandas()
    a = km[km.c == "a"].sort_values("time")
    np.testing.assert_allclose(a.survival, [0.75, 0.375, 0.0])
    assert (km[km.c == "b"].survival == 1).all()
    assert ((km.lower <= km.survival + 1e-12) & (km.upper >= km.survival - 1e-12)).all()
    med = {r["c"]: r["median_days"] for r in V.median_survival(spark.createDataFrame(km), "c").collect()}
    assert med["a"] == 2 and med["b"] is None


def test_metrics_match_their_definitions(spark):
    rng = np.random.default_rng(5)
    y, p = rng.integers(0, 2, 400), np.round(rng.random(400), 2)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "p": p}))
    r = M.binary_metrics(df, "y", "p").first()
    pos, neg = p[y == 1], p[y == 0]
    auc = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    ap, last = 0.0, 0.0
    for c in sorted(set(p), reverse=True):
        recall = (pos >= c).mean()
        ap += (recall - last) * (y[p >= c] == 1).mean()
        last = recall
    assert r["auc"] == pytest.approx(auc) and r["average_precision"] == pytest.approx(ap)
    one = M.binary_metrics(df.filter("y = 1"), "y", "p").first()
    assert one["auc"] is None and one["recall"] == pytest.approx((pos >= 0.5).mean())


def test_reliability_edges(spark):
    df = spark.createDataFrame([(0.1, 1), (0.1000001, 0), (0.0, 0), (1.0, 1)], "p double, y int")
    assert sorted((r["bin"], r["n"]) for r in M.reliability(df, "y", "p").collect()) == [(0, 2), (1, 1), (9, 1)]


def test_label_codes_are_alphabetical(spark):
    df = spark.createDataFrame([("b", 1), (None, 2), ("a", 3), ("z", 4), ("a", 5)], "c string, id int")
    codes = label_codes(df, ["c"])
    assert sorted((r["value"], r["code"]) for r in codes.collect()) == [("a", 0), ("b", 1), ("nan", 2), ("z", 3)]
    back = decode(encode(df, ["c"], codes=codes), "c_code", codes, "c", "c2")
    assert {r["id"]: r["c2"] for r in back.collect()} == {1: "b", 2: "nan", 3: "a", 4: "z", 5: "a"}


def test_vif_matches_direct_regression(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 3)) + 3
    x = np.column_stack([x, x[:, 0] + 0.1 * rng.normal(size=300)])
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abcd")))
    got = S.vif_table(df, list("abcd"))
    for i, c in enumerate("abcd"):
        rest = np.delete(x, i, 1)
        resid = x[:, i] - rest @ np.linalg.lstsq(rest, x[:, i], rcond=None)[0]
        assert got[c] == pytest.approx((x[:, i] ** 2).sum() / (resid**2).sum(), rel=1e-6)


def test_exact_combination_has_infinite_vif():
    x = np.random.default_rng(1).normal(size=(50, 2))
    x = np.column_stack([x, x[:, 0] * 2])
    v = S.vif_of(x.T @ x)
    assert np.isinf(v[0]) and np.isinf(v[2]) and v[1] < 2


def test_selection_phases(spark):
    rng = np.random.default_rng(4)
    n = 400
    a, b = rng.normal(size=n), rng.normal(size=n)
    pdf = pd.DataFrame({"id": range(n), "a": a, "b": b, "copy": a, "const": 1, "X_3ay": rng.normal(size=n),
                        "mix": a * 0.5 + b * 0.5 + 0.01 * rng.normal(size=n), "flag": rng.integers(0, 2, n), "Target_3M": rng.integers(0, 2, n)})
    cfg = S.SelectionConfig(id_column="id", targets=("Target_3M",), protected=("const2",), vif_target=5)
    out, decisions = S.select_features(spark.createDataFrame(pdf), cfg)
    status = {d.feature: d.status for d in decisions}
    assert status["const"] == "REMOVED_CONSTANT" and status["X_3ay"] == "REMOVED_LEAKAGE"
    assert status["copy"] == "REMOVED_HIGH_CORRELATION" and status["flag"] == "RETAINED"
    assert out.columns[:2] == ["id", "Target_3M"] and "a" in out.columns


def test_near_constant_does_not_depend_on_size(spark):
    df = spark.range(400).select(F.col("id"), (F.col("id") % 25).cast("double").alias("few"), F.when(F.col("id") < 399, 0.0).otherwise(50.0).alias("flat"),
                                 F.lit(None).cast("double").alias("void"))
    cfg = S.SelectionConfig(id_column="id")
    names = [[d.feature for d in S.find_near_constant(S.column_stats(x, x.columns[1:]), cfg, lambda c: False)]
             for x in (df, df.crossJoin(spark.range(10).select(F.lit(1).alias("k"))).drop("k"))]
    assert names == [["flat"], ["flat"]]


def test_only_text_columns_are_categories(spark):
    i = F.col("id")
    df = spark.range(400).select("id", (i % 40).cast("string").alias("c"), (i % 3).cast("double").alias("x"), ((i % 40 > 20) | (i % 3 == 1)).cast("int").alias("y"))
    p = T.prepare(df, "id", ["x"], ["c"], ["y"])
    attrs = p.table.schema["features"].metadata["ml_attr"]["attrs"]
    assert [a["name"] for a in attrs["numeric"]] == ["x"] and [len(a["vals"]) for a in attrs["nominal"]] == [41]
    text = T.fit_classifier(p.table, "y", T.Settings(family="categorical", max_iter=2, depth=3), "id").stages[-1].toDebugString
    assert "feature 1 in {" in text and "feature 0 <=" in text and "feature 0 in" not in text
    text = T.fit_classifier(p.table, "y", T.Settings(max_iter=2, depth=3), "id").stages[-1].toDebugString
    assert " in {" not in text


def test_held_out_rows_do_not_change_the_training_matrix(spark, tmp_path):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"id": range(300), "a": rng.normal(size=300), "void": np.nan, "kind": rng.choice(["p", "q"], 300)})
    pdf["y"] = (pdf.a > 0).astype(int)
    pdf.loc[::9, "a"], pdf.loc[::11, "kind"] = np.nan, None
    df = spark.createDataFrame(pdf)
    p, train, test = T.prepared_split(df, "id", "y", ["a", "void"], ["kind"])
    assert p.table.count() == 300 and test.count() == sum(int(np.ceil(n * 0.3)) for n in pdf.groupby("y").size())
    out = F.col("id").isin([r["id"] for r in test.collect()])
    odd = df.withColumns({"a": F.when(out, F.lit(1e9)).otherwise(F.col("a")), "kind": F.when(out, F.lit("another")).otherwise(F.col("kind"))})
    q, again, other = T.prepared_split(odd, "id", "y", ["a", "void"], ["kind"])

    def matrix(x):
        return {r["id"]: tuple(r["features"]) for r in x.collect()}

    assert matrix(train) == matrix(again) and matrix(test) != matrix(other)
    inside = pdf[~pdf.id.isin([r["id"] for r in test.collect()])]
    assert p.model.stages[0].getOrDefault("medians") == [pytest.approx(inside.a.median()), 0.0]
    assert {v[2] for v in matrix(other).values()} == {3.0}  # a label that was not seen
    model = T.with_preparation(p, T.fit_classifier(train, "y", T.Settings(max_iter=2, depth=2), "id"))
    T.save_model(model, str(tmp_path / "m"))
    loaded = T.load_model(str(tmp_path / "m"))
    a, b = (x.transform(odd).agg(F.sum(vector_to_array("probability")[1])).first()[0] for x in (model, loaded))
    assert a == pytest.approx(b)


def test_stratified_split_is_exact_and_stable(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    train, test = T.stratified_split(df, "id", ["y"])
    again = T.stratified_split(df.repartition(7), "id", ["y"])[1]
    counts = {r["y"]: r["count"] for r in test.groupBy("y").count().collect()}
    assert counts == {0: 270, 1: 30} and train.count() == 700
    assert {r["id"] for r in test.collect()} == {r["id"] for r in again.collect()}
    folds = T.with_folds(df, "id", ["y"]).groupBy("y", "fold").count().collect()
    assert sorted(r["count"] for r in folds) == [33, 33, 34, 300, 300, 300]


@pytest.mark.parametrize("dims", [1, 3])
def test_nearest_is_exact_over_blocks(spark, dims):
    rng = np.random.default_rng(dims)
    x = rng.normal(size=(240, dims))
    df = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(len(x))], "id long, x array<double>")
    got = {r["id"]: [round(e["distance"], 9) for e in r["near"]] for r in O.nearest(df, 4, block_rows=25).collect()}
    d = np.sqrt(((x[:, None] - x) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    assert got == {i: [round(v, 9) for v in np.sort(d[i])[:4]] for i in range(len(x))}


def test_smote_reaches_the_ratio_between_neighbours(spark):
    rng = np.random.default_rng(9)
    rows = [(i, 0, [float(v) for v in rng.normal(size=2)]) for i in range(200)]
    rows += [(1000 + i, 1, [float(i % 7), float(i // 7)]) for i in range(14)] + [(2000 + i, 1, [0.0, 0.0]) for i in range(6)]
    df = spark.createDataFrame(rows, "id long, y int, f array<double>").select("id", "y", array_to_vector("f").alias("features"))
    out = np.array([r["features"] for r in O.smote(df, "y", "id").collect()])
    assert len(out) == int(200 * 0.33) - 20
    assert out.min() >= 0 and out[:, 0].max() <= 6 and out[:, 1].max() <= 1
    again = np.array([r["features"] for r in O.smote(df.repartition(5), "y", "id").collect()])
    np.testing.assert_allclose(np.sort(out, 0), np.sort(again, 0))


def test_calibration_is_monotone(spark):
    rng = np.random.default_rng(3)
    p = np.round(rng.random(500), 3)
    df = spark.createDataFrame(pd.DataFrame({"p": p, "y": (rng.random(500) < p**2).astype(int)}))
    iso = C.apply_isotonic(C.calibrate_isotonic(df, "y", "p"), df, "p", "q").toPandas().sort_values("p")
    assert (np.diff(iso.q) >= -1e-12).all() and iso.q.between(0, 1).all()
    platt = C.apply_platt(C.calibrate_platt(df, "y", "p"), df, "p", "q").toPandas().sort_values("p")
    assert (np.diff(platt.q) >= -1e-12).all()
    assert abs(iso.q.mean() - iso.y.mean()) < 0.02


def test_model_explanations_and_storage(spark, tmp_path):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame(rng.normal(size=(300, 2)), columns=["a", "b"])
    pdf["id"], pdf["kind"] = range(300), np.where(pdf.b > 0, "x", None)
    pdf["target_6M"] = (pdf.a > 0.3).astype(int)
    pdf.loc[::10, "b"] = np.nan
    df = spark.createDataFrame(pdf)
    s = T.Settings(max_iter=3, depth=2)
    fitted, metrics = T.fit_pof(df, "id", ["6M"], ["a", "b"], ["kind"], s)
    prepared, models = fitted["6M"][0], {"6M": fitted["6M"][1]}
    assert metrics.first()["auc"] > 0.95
    contributions = X.contributions(models["6M"], prepared.table, "id", prepared.features, X.baseline(prepared.table, prepared.features))
    assert contributions.count() == 300 * 3
    top = X.explain_top_assets(models["6M"], prepared.table, "id", prepared.features, n=5, k=2).collect()
    assert len(top) == 5 and all(r["top_factor"] == "a" and r["explanation"].count("|") == 1 for r in top)
    assert X.global_importance({"6M": (prepared.table, models["6M"])}, "id", prepared.features).orderBy("rank").first()["feature"] == "a"
    T.save_model(models["6M"], str(tmp_path / "m"))
    loaded = T.load_model(str(tmp_path / "m"))
    a, b = (T.probabilities(m, prepared.table).agg(F.sum("probability_1")).first()[0] for m in (models["6M"], loaded))
    assert a == pytest.approx(b)


def test_fits_of_the_horizons_run_side_by_side(spark, monkeypatch):
    from faultline.catalog import learning as Q

    meet = threading.Barrier(len(Q.HORIZONS), timeout=30)

    def trained(labels, horizon="6M", family="boosted"):
        meet.wait()
        return SimpleNamespace(table=horizon, features=["a"]), None, None, family

    monkeypatch.setattr(Q, "labelled", lambda *_: spark.range(1))
    monkeypatch.setattr(Q, "trained", trained)
    monkeypatch.setattr(X, "global_importance", lambda models, *_: models)
    monkeypatch.setattr(X, "explain_top_assets", lambda model, table, *_, **more: spark.createDataFrame([(table,)], "of string"))
    monkeypatch.setattr(T, "evaluate", lambda model, test, label, horizon, name: (horizon, name))
    monkeypatch.setattr(M, "compare_models", list)
    assert Q.global_importance(spark, "") == {h: (h, "boosted") for h in Q.HORIZONS}
    assert {tuple(r) for r in Q.asset_explanations(spark, "").collect()} == {(h, h) for h in Q.HORIZONS}
    assert Q.failure_model_families(spark, "") == [(h, f) for f in ("boosted", "categorical") for h in Q.HORIZONS]
