import datetime as dt

import pytest
from pyspark.sql import functions as F

from faultline import catalog, vocabulary
from faultline.operators import clean, labels as L, ordered as O, profile as P, risk as K, schema as N, sets, validate as V
from faultline.sources import tables as R

T0 = dt.datetime(2024, 6, 25)
CUTOFF = "2024-06-25 00:00:00"


def test_every_query_is_registered_once_and_sql_has_a_query():
    catalog.load_all()
    assert len(catalog.QUERIES) > 120
    assert set(catalog.SQL) <= set(catalog.QUERIES)


def test_horizons_use_calendar_months(spark):
    rows = [(1, dt.datetime(2024, 9, 25)), (2, dt.datetime(2024, 9, 25, 0, 0, 1)), (3, T0), (None, dt.datetime(2024, 7, 1))]
    ev = spark.createDataFrame(rows, "asset long, ts timestamp_ntz")
    assert [r["asset"] for r in L.horizon_ids(ev, "asset", "ts", CUTOFF, 3).collect()] == [1]
    assets = spark.createDataFrame([(1,), (2,), (3,)], "asset long")
    got = {r["asset"]: r[1:] for r in L.make_targets(assets, ev, "asset", "ts", CUTOFF).collect()}
    assert got == {1: (1, 1, 1), 2: (0, 1, 1), 3: (0, 0, 0)}


def test_admission_of_healthy_assets(spark):
    rows = [(1, T0), (1, T0 - dt.timedelta(1)), (2, T0 + dt.timedelta(seconds=1)), (3, None), (None, T0), (4, T0)]
    a = spark.createDataFrame(rows, "id long, install timestamp_ntz").withColumn("life", F.when(F.col("id") != 4, 10))
    got = clean.admit_healthy(a, "id", "install", CUTOFF, ["install"], "life").collect()
    assert [(r["id"], r["install"]) for r in got] == [(1, T0 - dt.timedelta(1))]


def test_mixed_union_has_explicit_defaults(spark):
    failed = spark.createDataFrame([(1, 3, 20.0)], "asset long, n_events long, mtbf_days double")
    healthy = spark.createDataFrame([(2,)], "asset long")
    got = {r["asset"]: r.asDict() for r in sets.union_mixed(failed, healthy).collect()}
    assert got[2] == {"asset": 2, "n_events": 0, "mtbf_days": None, "has_failure_history": 0, "data_source": "Healthy_Equipment"}
    assert got[1]["has_failure_history"] == 1 and got[1]["data_source"] == "Failed_Equipment"


def test_split_keeps_unknown(spark):
    df = spark.createDataFrame([(1,), (None,), (5,)], "v int")
    kept, bad = clean.split(df, F.col("v") > 3)
    assert (kept.count(), bad.count()) == (2, 1)


def test_anti_join_ignores_null_keys(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(None,), (2,), (2,)], "k int")
    assert [r["k"] for r in clean.without(a, b, "k").collect()] == [1]


def test_outage_falls_back_to_the_median_then_the_default(spark):
    assets = spark.createDataFrame([(1,), (2,), (3,), (4,)], "a long")
    ev = spark.createDataFrame([(1, 10.0), (1, 20.0), (2, 100.0), (3, 10080.0), (3, 0.0)], "a long, m double")
    got = {r["a"]: r[1] for r in K.average_outage(assets, ev, "a", "m").collect()}
    assert got == {1: 15.0, 2: 100.0, 3: 57.5, 4: 57.5}
    assert {r[1] for r in K.average_outage(assets, ev.limit(0), "a", "m").collect()} == {120.0}


def test_risk_ranks_within_horizon_and_keeps_missing(spark):
    base = spark.createDataFrame([(1, "6M", 0.5, 10.0), (2, "6M", 0.5, 10.0), (3, "6M", 0.1, 1.0), (1, "12M", 0.9, 10.0), (4, "6M", 0.2, None)],
                                 "a long, horizon string, pof double, cof_raw double")
    got = {(r["a"], r["horizon"]): (r["risk_score"], r["priority_rank"], r["risk_category"]) for r in K.risk(base, "pof", ["horizon"]).collect()}
    assert got[(1, "6M")] == got[(2, "6M")] == (pytest.approx(250 / 3), 1, "ORTA")
    assert got[(3, "6M")][1] == 3 and got[(1, "12M")] == (100.0, 1, "KRİTİK") and got[(4, "6M")] == (None, None, None)


def test_scores_and_validation(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "b", "y")], "id int, k string, Target_x string")
    got = {r["check"]: r["status"] for r in V.validate(df, V.TableRules(1, 1, 2, 5, ("id", "k", "gone"), "id", True)).collect()}
    assert got == {"min_rows": "pass", "max_rows": "fail", "min_columns": "pass", "max_columns": "pass", "has id": "pass",
                   "has k": "pass", "has gone": "fail", "no nulls in k": "fail", "no leaking names": "fail"}


def test_names():
    names = vocabulary.COLUMN_NAMES
    assert N.leaky_names(["Arıza_Sayısı_3ay", "Toplam_Arıza_Sayısı_3M", "x", "PoF_Probability"]) == {
        "Arıza_Sayısı_3ay": "temporal_window", "PoF_Probability": "target_derived"}
    assert N.is_protected("OAZS_Gün", vocabulary.PROTECTED, names) and N.is_protected("MTBF_Gün", vocabulary.PROTECTED, names)
    assert not N.is_protected("Risk_Score", vocabulary.PROTECTED, names)
    assert N.classify_names(["OAZS_Gün", "MTBF_Gün", "q"], names) == {"OAZS_Gün": "valid", "MTBF_Gün": "invalid", "q": "unknown"}
    assert N.resolve_column(["a", "Started At"], ["b"], ["started"]) == "Started At"
    assert N.resolve_column(["a"], ["b"]) is None


def test_required_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert N.require_columns(df, ["a"], ["b", "c"]) == ["c"]
    with pytest.raises(ValueError, match="missing required columns: z"):
        N.require_columns(df, ["z"])


def test_profile_of_empty_and_null_columns(spark):
    df = spark.createDataFrame([(None, 1), (None, 1)], "a string, b int")
    for distinct in ("exact", "sketch"):
        got = {r["column"]: (r["non_null"], r["n_distinct"], r["null_pct"]) for r in P.profile(df, distinct).collect()}
        assert got == {"a": (0, 0, 100.0), "b": (2, 1, 0.0)}
    plain = P.profile(df)
    assert {r["column"]: (r["non_null"], r["null_pct"], r["sample_value"]) for r in plain.collect()} == {"a": (0, 100.0, None), "b": (2, 0.0, "1")}
    with pytest.raises(ValueError, match="distinct is"):
        P.profile(df, "some")


def test_imputation_of_an_empty_column(spark):
    df = spark.createDataFrame([(None, 1.0), (None, float("inf")), (None, 5.0)], "a double, b double")
    assert sorted(r[:] for r in P.impute(df, median=["a", "b"]).collect()) == [(0.0, 1.0), (0.0, 3.0), (0.0, 5.0)]


def test_binned_mean_of_one_value(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "x double, y double")
    assert [r[:] for r in P.binned_mean(df, "x", "y", 4).collect()] == [(1, 2, 2.0)]


def test_csv_needs_a_schema_and_bad_ids_become_null(spark, tmp_path):
    path = str(tmp_path / "c")
    R.write_csv(spark.createDataFrame([("17.0", "15-01-2021"), ("x", "junk")], "id string, d string"), path)
    with pytest.raises(ValueError):
        R.load_fault_log(spark, path, fmt="csv")
    got = R.load_fault_log(spark, path, "id string, d string", "csv", "id", ["d"]).collect()
    assert {(r["id"], r["d"]) for r in got} == {(17, dt.datetime(2021, 1, 15)), (None, None)}


def test_first_available(spark, tmp_path):
    R.write_table(spark.range(3).toDF("a"), str(tmp_path / "b"))
    path, df = R.first_available(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert path.endswith("b") and df.count() == 3
    with pytest.raises(FileNotFoundError):
        R.first_available(spark, [str(tmp_path / "z")])


def test_ids_keep_every_digit(spark):
    texts = ["9007199254740993", "9007199254740992", "17.0", "1.7e1", "17.9", "abc", "", None, "9223372036854775808", " 5 ", "-3", "1e300", "NaN"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("id", R.whole_id(F.col("t")))
    assert [r["id"] for r in df.orderBy("i").collect()] == [
        9007199254740993, 9007199254740992, 17, 17, None, None, None, None, None, 5, -3, None, None]


def test_write_split_computes_once(spark, tmp_path):
    df = spark.range(1000).select("id", F.rand().alias("x"))
    kept = R.write_split(df, F.col("x") > 0.5, str(tmp_path / "bad"))
    bad = spark.read.parquet(str(tmp_path / "bad"))
    assert kept.count() + bad.count() == 1000 and kept.filter("x > 0.5").isEmpty() and bad.filter("x <= 0.5").isEmpty()
    assert kept.columns == bad.columns == ["id", "x"]


def test_best_by_ignores_undefined_metrics(spark):
    df = spark.createDataFrame([("a", "m1", float("nan")), ("a", "m2", 0.7), ("a", "m3", 0.7), ("b", "m4", None), ("b", "m5", float("nan"))],
                               "h string, model string, auc double")
    got = {r["h"]: r["model"] for r in O.best_by(df, ["h"], "auc").collect()}
    assert got == {"a": "m2", "b": "m4"}
    assert {r["h"]: r["model"] for r in O.best_by(df, ["h"], "auc", largest=False).collect()}["a"] == "m2"


def test_path_exists(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    R.write_table(spark.range(2).toDF("a"), str(tmp_path / "full"))
    assert [R.path_exists(spark, str(tmp_path / x)) for x in ("none", "empty", "full")] == [False, False, True]
