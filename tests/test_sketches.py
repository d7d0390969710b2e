"""Column sketches, pair sums, and what must not be shuffled."""

import numpy as np
import pytest

from faultline.operators import moments, profile as P, select as S, sketches


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sketches_of_parts_add_up(spark):
    df = spark.range(60_000).selectExpr(
        "id", "CAST(id % 700 AS INT) AS few", "CASE WHEN id % 10 < 9 THEN 'often' ELSE concat('x', id) END AS often", "CAST(NULL AS DOUBLE) AS nothing",
        "7 AS same", "CASE WHEN id % 4 = 0 THEN CAST(id / 3 AS STRING) END AS gaps")
    whole = {r["column"]: r for r in sketches.report(sketches.sketch(df)).collect()}
    parts = [sketches.sketch(df.where(f"id % 3 = {k}")) for k in range(3)]
    merged = {r["column"]: r for r in sketches.report(sketches.merge(parts[0].unionAll(parts[1]).unionAll(parts[2])), top=2).collect()}
    for got in (whole, merged):
        assert {c: r["non_null"] for c, r in got.items()} == {"id": 60_000, "few": 60_000, "often": 60_000, "nothing": 0, "same": 60_000, "gaps": 15_000}
        assert (got["few"]["n_distinct"], got["same"]["n_distinct"], got["nothing"]["n_distinct"]) == (700, 1, 0)
        for c, n in (("id", 60_000), ("often", 6_001), ("gaps", 15_000)):
            assert abs(got[c]["n_distinct"] - n) <= 0.03 * n
        assert got["id"]["n_most"] <= 100
        assert (got["same"]["n_most"], got["nothing"]["n_most"]) == (60_000, None)
        assert abs(got["often"]["n_most"] - 54_000) <= 100 and got["often"]["sample_value"] == "often"
    assert [x["item"] for x in merged["often"]["top_values"]][0] == "often"


def test_sketches_of_an_empty_table(spark):
    got = sketches.report(sketches.sketch(spark.range(0).selectExpr("id", "CAST(id AS STRING) AS t"))).collect()
    assert [(r["column"], r["n_rows"], r["n_distinct"], r["n_most"]) for r in got] == [("id", 0, 0, None), ("t", 0, 0, None)]


def test_profiles_exchange_no_values(spark):
    df = spark.range(1000).selectExpr("id", "CAST(id AS STRING) AS t")
    for distinct in (None, "sketch"):
        plan = plan_of(P.profile(df, distinct))
        assert "hashpartitioning" not in plan and plan.count("Exchange") == 1
    assert "hashpartitioning" in plan_of(P.profile(df, "exact"))


def test_wide_tables_are_sketched_in_passes(spark, monkeypatch):
    monkeypatch.setattr(sketches, "WIDTH", 3)
    df = spark.range(50).selectExpr(*[f"id % {k + 1} AS c{k}" for k in range(8)])
    assert {r["column"]: r["n_distinct"] for r in sketches.report(sketches.sketch(df)).collect()} == {f"c{k}": k + 1 for k in range(8)}


def gappy(n=4000, p=12, seed=3):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, p)) + draw.normal(size=(n, 1)) * np.linspace(0, 2, p)
    x[:, 1] += 1e9  # large offset
    x[:, 2] = 5.0
    x[draw.random((n, p)) < 0.2] = np.nan
    return x


def test_pair_sums(spark):
    x = gappy()
    rows = [[None if np.isnan(v) else float(v) for v in r] for r in x]
    rows[0][3], rows[1][3], x[0, 3], x[1, 3] = float("inf"), float("nan"), np.nan, np.nan
    names = [f"c.{k}" for k in range(x.shape[1])]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in names)).repartition(5)
    found = {(r["feature_1"], r["feature_2"]): r["r"] for r in P.correlations(df, names).collect()}
    assert len(found) == 66
    for i in range(12):
        for j in range(i + 1, 12):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            r = found[names[i], names[j]]
            if 2 in (i, j):
                assert r is None
            else:
                assert r == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-6 if 1 in (i, j) else 1e-10)
    full = np.nan_to_num(x, nan=1.0)
    df = spark.createDataFrame(full.tolist(), names)
    assert np.allclose(moments.gram(df, names), full.T @ full, rtol=1e-12)
    assert "hashpartitioning(i" in plan_of(moments.pair_sums(df, names)) and plan_of(moments.pair_sums(df, names)).count("Scan ExistingRDD") == 1


def test_pair_sums_of_little(spark):
    one = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert [r["r"] for r in P.correlations(one, ["a", "b"]).collect()] == [None]
    assert P.correlations(one, ["a"]).count() == 0
    assert (moments.gram(one.limit(0), ["a", "b"]) == 0).all()


def test_known_selection(spark):
    """A table of which it is known what each phase removes."""
    draw = np.random.default_rng(9)
    n = 600
    a, b, c = draw.normal(size=(3, n))
    rows = [(i, float(a[i]), float(b[i]), float(a[i] * 2 + 1e-4 * c[i]), 7, 1 if i == 5 else 0, float(a[i] + b[i] + 0.05 * c[i]), float(c[i]), float(a[i]))
            for i in range(n)]
    df = spark.createDataFrame(rows, "id long, a double, b double, a_again double, constant int, rare int, mixture double, c double, target_12m double").cache()
    cfg = S.SelectionConfig(id_column="id", correlation_limit=0.95)
    table, found = S.select_features(df, cfg)
    status = {d.feature: d.status for d in found}
    assert status["constant"] == "REMOVED_CONSTANT" and status["rare"] == "REMOVED_NEAR_CONSTANT"
    assert status["a_again"] == "REMOVED_HIGH_CORRELATION" and status["c"] == "RETAINED"
    assert sum(status[k] == "REMOVED_HIGH_VIF" for k in ("a", "b", "mixture")) == 1
    assert table.columns == ["id", *[d.feature for d in found if d.status == "RETAINED"]]
