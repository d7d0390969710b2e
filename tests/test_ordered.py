import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from faultline.operators import clean, ordered as O, rollup as R, survival as V

T0 = dt.datetime(2024, 1, 1)
CUTOFF = "2024-06-25 00:00:00"


def skewed_events(n=900, seed=1):
    """A third of all events belong to one asset and many share an instant."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a = 0 if i % 3 == 0 else rng.randrange(1, 40)
        out.append((a, T0 + dt.timedelta(hours=rng.randrange(0, 24 * 200)), i))
    return pd.DataFrame(out, columns=["asset", "ts", "event"])


@pytest.fixture(scope="module")
def events(spark):
    pdf = skewed_events()
    return pdf, spark.createDataFrame(pdf, "asset long, ts timestamp_ntz, event long").persist()


@pytest.mark.parametrize("block", ["day", "month", "year"])
def test_event_chain_matches_pandas(events, block):
    pdf, df = events
    p = pdf.groupby(["asset", "ts"]).size().rename("n").reset_index().sort_values(["asset", "ts"])
    p["seq"] = p.groupby("asset")["n"].cumsum()
    p["prev_ts"] = p.groupby("asset")["ts"].shift(1)
    p["next_ts"] = p.groupby("asset")["ts"].shift(-1)
    got = O.event_chain(df, "asset", "ts", block).toPandas().sort_values(["asset", "ts"])
    pd.testing.assert_frame_equal(got.reset_index(drop=True), p.reset_index(drop=True), check_dtype=False)


def test_recurrence_and_rollup_match_a_scan_per_asset(events):
    pdf, df = events
    spec = R.EventSpec("asset", "ts", ("event",), recurrence_days=(1, 3))
    got = R.reliability(R.rollup(df, spec, CUTOFF), CUTOFF).toPandas().set_index("asset")
    cutoff = pd.Timestamp(CUTOFF)
    for asset, g in pdf[pdf.ts <= cutoff].groupby("asset"):
        ts = g.ts.sort_values()
        gap = ts.diff().dt.days.dropna()
        row = got.loc[asset]
        assert row.n_events == len(ts) and row.first_event == ts.iloc[0] and row.last_event == ts.iloc[-1]
        assert row.recurs_1d == int((gap <= 1).any()) and row.recurs_3d == int((gap <= 3).any())
        assert row.events_3m == (ts >= cutoff - pd.Timedelta(days=90)).sum()
        days = (ts.iloc[-1] - ts.iloc[0]).days
        expected = days / (len(ts) - 1) if len(ts) > 1 and days > 0 else None
        assert (pd.isna(row.mtbf_days) and expected is None) or row.mtbf_days == pytest.approx(expected)


def gap_flags(spark, offsets):
    df = spark.createDataFrame([(1, T0 + o, i) for i, o in enumerate(offsets)], "asset long, ts timestamp_ntz, event long")
    r = R.rollup(df, R.EventSpec("asset", "ts", ("event",)), "2025-06-25 00:00:00").first()
    return r["recurs_30d"], r["recurs_90d"]


def test_gap_boundaries(spark):
    day = dt.timedelta(days=1)
    assert gap_flags(spark, [0 * day]) == (0, 0)
    assert gap_flags(spark, [0 * day, 30 * day]) == (1, 1)
    assert gap_flags(spark, [0 * day, 31 * day - dt.timedelta(microseconds=1)]) == (1, 1)  # whole days are counted
    assert gap_flags(spark, [0 * day, 31 * day]) == (0, 1)
    assert gap_flags(spark, [0 * day, 91 * day]) == (0, 0)
    assert gap_flags(spark, [5 * day, 5 * day]) == (1, 1)
    assert gap_flags(spark, [0 * day, 89 * day, 200 * day]) == (0, 1)


def test_cutoff_is_inclusive(spark):
    at, after = dt.datetime(2024, 6, 25), dt.datetime(2024, 6, 25, 0, 0, 0, 1)
    df = spark.createDataFrame([(1, at), (2, after)], "asset long, ts timestamp_ntz")
    assert [r["asset"] for r in clean.history(df, "ts", CUTOFF).collect()] == [1]
    assert [r["asset"] for r in clean.future(df, "ts", CUTOFF).collect()] == [2]


def test_first_of_skips_nulls_and_follows_event_time(spark):
    df = spark.createDataFrame([(1, T0, 2, None, "b"), (1, T0, 1, "x", None), (1, T0 + dt.timedelta(1), 3, "y", "c")],
                               "asset long, ts timestamp_ntz, event long, attr string, cause string")
    r = R.rollup(df, R.EventSpec("asset", "ts", ("event",), cause="cause", first_of=("attr",)), CUTOFF).first()
    assert (r["attr"], r["cause_first"], r["cause_last"], r["cause_mode"], r["cause_diversity"]) == ("x", "b", "c", "b", 2)
    assert r["cause_consistency"] == 0.5


def test_ranks_match_pandas(spark):
    rng = np.random.default_rng(0)
    v = np.where(rng.random(500) < 0.33, 7.0, rng.integers(0, 60, 500).astype(float))
    pdf = pd.DataFrame({"id": range(500), "v": v})
    pdf.loc[::50, "v"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    got = O.with_ranks(df, "v", "pct", "prio").toPandas().sort_values("id")
    np.testing.assert_allclose(got["pct"], pdf.v.rank(pct=True) * 100, equal_nan=True)
    np.testing.assert_allclose(got["prio"], pdf.v.rank(ascending=False, method="min"), equal_nan=True)


def test_rank_of_one_row(spark):
    df = spark.createDataFrame([(5.0,)], "v double")
    assert O.with_ranks(df, "v", "pct", "prio").first()[:] == (5.0, 100.0, 1)


@pytest.mark.parametrize("blocks", [1, 3, 64])
def test_quantiles_match_pandas(spark, blocks):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.integers(0, 4, 700), "a": rng.normal(size=700), "b": rng.integers(0, 5, 700).astype(float)})
    pdf.loc[pdf.index % 3 == 0, "a"] = 0.25
    got = O.quantiles(spark.createDataFrame(pdf), ["a", "b"], {"q1": 0.1, "q5": 0.5, "q9": 0.937}, ["g"], blocks).toPandas()
    for r in got.itertuples():
        x = pdf[pdf.g == r.g][r.column]
        np.testing.assert_allclose([r.q1, r.q5, r.q9], x.quantile([0.1, 0.5, 0.937]))
    assert len(got) == 8


def test_cumulative_totals(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 1.0), (1, 3.0), (2, 2.0), (2, None)], "g int, v double")
    got = sorted(r[:] for r in O.cumulative(df, "v", by=["g"]).collect())
    assert got == [(1, 1.0, 2, 0, 3), (1, 3.0, 1, 2, 3), (2, 2.0, 1, 0, 1)]


def test_removed_duplicates_keep_every_row(spark):
    data = [(1, 1, "a")] * 5 + [(1, 1, "b"), (1, None, "c"), (1, None, "d"), (2, 1, "e")]
    df = spark.createDataFrame(data, "k int, t int, p string")
    kept = clean.dedup_by_key(df, ["k", "t"], ["p"])
    removed = clean.removed_duplicates(df, ["k", "t"], ["p"])
    assert {tuple(r) for r in kept.collect()} == {(1, None, "c"), (1, 1, "a"), (2, 1, "e")} and kept.count() == 3
    assert sorted(r["p"] + str(r["copies"]) for r in removed.collect()) == ["a4", "b1", "d1"]
    assert removed.agg(F.sum("copies")).first()[0] + kept.count() == len(data)


def test_survival_intervals_match_a_loop(events):
    pdf, df = events
    cutoff, expected = pd.Timestamp(CUTOFF), []
    for asset, g in pdf[pdf.ts <= cutoff].groupby("asset"):
        ts = list(g.sort_values(["ts", "event"]).ts)
        for i, t in enumerate(ts):
            nxt = ts[i + 1] if i + 1 < len(ts) else None
            days = ((nxt or cutoff) - t).days
            if days > 0:
                expected.append((asset, t.to_pydatetime(), days, int(nxt is not None), i + 1))
    got = [tuple(r) for r in V.survival_intervals(df, "asset", "ts", CUTOFF).collect()]
    assert sorted(got) == sorted(expected)


def test_plans_have_no_cross_join_and_push_the_cutoff(spark, tmp_path, events):
    _, df = events
    df.write.parquet(str(tmp_path / "e"))
    stored = spark.read.parquet(str(tmp_path / "e"))
    plan = R.rollup(stored, R.EventSpec("asset", "ts", ("event",)), CUTOFF)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(ts), LessThanOrEqual(ts," in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert plan.split("== Physical Plan ==")[1].count("Exchange hashpartitioning") == 2


def test_top_k_per_group_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("s"), "id")
    out = O.top_k_per(df, ["g"], "s", "id", 2)
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["id"] for r in out.collect()) == [994, 995, 996, 997, 998, 999]
