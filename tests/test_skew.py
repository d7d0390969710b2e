import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from faultline.operators import clean, ordered as O, rollup as R

T0 = dt.datetime(2024, 3, 1)


@pytest.fixture
def hot_day(spark):
    """Half of all instants fall on one day of one asset, most of those within a minute."""
    n = 40_000
    i = F.col("id")
    near = F.when(i % 10 < 8, i * 1_000).otherwise(i * 2_000_000)
    hot = spark.range(n).select(F.lit(0).cast("long").alias("asset"), near.alias("us"))
    rest = spark.range(n).select((i % 5_000 + 1).alias("asset"), (i * 104_729_000_001 % (300 * 86_400_000_000)).alias("us"))
    base = int((T0 - dt.datetime(1970, 1, 1)).total_seconds()) * 1_000_000
    both = hot.unionAll(rest).select("asset", F.timestamp_micros(F.lit(base) + F.col("us")).cast("timestamp_ntz").alias("ts"))
    before = spark.conf.get("spark.sql.adaptive.skewJoin.enabled")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    yield both.persist()
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", before)


def test_a_hot_day_is_cut_into_even_pieces(spark, hot_day):
    points = hot_day.groupBy("asset", "ts").agg(F.count(F.lit(1)).alias("n")).withColumn("_block", F.date_trunc("day", "ts"))
    cut = O.with_pieces(points, "asset", "ts")
    total = cut.count()
    assert total == points.count()
    # What one window group holds, and what one task of eight gets.
    assert cut.groupBy("asset", "_block", "_piece").count().agg(F.max("count")).first()[0] < total / 200
    tasks = [r["count"] for r in cut.repartition(8, "asset", "_block", "_piece").groupBy(F.spark_partition_id()).count().collect()]
    assert max(tasks) <= 2 * sorted(tasks)[len(tasks) // 2]
    assert cut.filter((F.col("asset") > 0) & (F.col("_piece") > 0)).count() == 0


def test_the_chain_runs_over_the_pieces(hot_day):
    p = hot_day.toPandas().groupby(["asset", "ts"]).size().rename("n").reset_index().sort_values(["asset", "ts"])
    p["seq"] = p.groupby("asset")["n"].cumsum()
    p["prev_ts"] = p.groupby("asset")["ts"].shift(1)
    p["next_ts"] = p.groupby("asset")["ts"].shift(-1)
    got = O.event_chain(hot_day, "asset", "ts").toPandas().sort_values(["asset", "ts"])
    pd.testing.assert_frame_equal(got.reset_index(drop=True), p.reset_index(drop=True), check_dtype=False)


def test_chain_of_an_empty_log(spark):
    empty = spark.createDataFrame([], "asset long, ts timestamp_ntz")
    assert O.event_chain(empty, "asset", "ts").collect() == []


def test_stage_counts_follow_the_filters(spark, tmp_path):
    rows = [(1, 10, 1, 5), (1, 10, 2, 50), (1, 20, 3, 50), (2, 10, 4, None), (2, 10, 4, None), (3, 40, 5, 1), (None, 10, 6, 1), (4, 15, 7, 99)]
    spark.createDataFrame(rows, "asset int, ts int, event int, install int").write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    after = ~F.coalesce(F.col("ts") < F.col("install"), F.lit(False))
    out = clean.stage_counts(log, "asset", ["asset", "ts"], ["event"], [("after", after), ("history", F.col("ts") <= 30)])
    first = clean.dedup_by_key(log, ["asset", "ts"], ["event", "install"])
    stages = [log, first, first.filter(after), first.filter(after).filter("ts <= 30")]
    want = [(s.count(), s.agg(F.count_distinct("asset")).first()[0]) for s in stages]
    got = out.orderBy("step").collect()
    assert [(r.n_rows, r.n_assets) for r in got] == want
    assert [r.lost_pct for r in got] == [pytest.approx((1 - a / want[0][1]) * 100) for _, a in want]
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    with pytest.raises(ValueError):
        clean.stage_counts(log, "asset", ["ts"], ["event"], [])
    empty = clean.stage_counts(log.limit(0), "asset", ["asset", "ts"], ["event"], [("after", after)]).collect()
    assert [(r.n_rows, r.n_assets, r.lost_pct) for r in empty] == [(0, 0, None)] * 3


@pytest.mark.parametrize("text_ids", [False, True])
def test_rollup_reads_the_log_once_and_sorts_none_of_it(spark, tmp_path, text_ids):
    """A third of all events on one asset; missing causes, attributes and ids; ties broken by the id."""
    i = F.col("id")
    asset = F.when(i % 3 == 0, F.lit(0)).otherwise(i % 37 + 1).cast("long")
    ts = F.timestamp_micros(F.lit(1_600_000_000_000_000) + (i * 7919 % 400) * 86_400_000_000).cast("timestamp_ntz")
    event = F.when(i % 97 > 0, i * 31 % 1000 - 500 + i * 1000)
    made = spark.range(3000).select(
        asset.alias("asset"), ts.alias("ts"), (event.cast("string") if text_ids else event).alias("event"),
        F.when(i % 5 > 0, F.concat(F.lit("c"), i * 13 % 7)).alias("cause"),
        F.when(i % 4 > 0, F.concat(F.lit("a"), i * 17 % 11)).alias("attr"), F.when(i % 6 > 0, i * 19 % 23).alias("size"))
    made.write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    spec = R.EventSpec("asset", "ts", ("event",), cause="cause", first_of=("attr", "size"))
    out = R.rollup(log, spec, "2021-06-01 00:00:00")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan
    assert ("SortAggregate" in plan) == text_ids
    pdf = log.filter("ts <= timestamp_ntz'2021-06-01'").toPandas()
    pdf["event"] = pdf.event.astype(object).where(pdf.event.notna(), "" if text_ids else -(2**62))
    got = out.toPandas().set_index("asset")
    assert len(got) == pdf.asset.nunique()
    for asset, g in pdf.sort_values(["ts", "event"]).groupby("asset"):
        row, causes = got.loc[asset], g.cause.dropna()
        ties = g.duplicated(["ts", "event"], keep=False)
        k = causes.value_counts()
        assert row.n_events == len(g) and row.cause_diversity == len(k)
        assert row.cause_consistency == pytest.approx(k.max() / k.sum()) and row.cause_mode == min(k[k == k.max()].index)
        gap = g.ts.diff().dt.days.dropna()
        assert row.recurs_30d == int((gap <= 30).any()) and row.recurs_90d == int((gap <= 90).any())
        for name, values in (("attr", g.attr[~ties]), ("size", g["size"][~ties]), ("cause_first", g.cause[~ties])):
            if not ties.any():
                assert row[name] == values.dropna().iloc[0]
        if not ties.any():
            assert row.cause_last == causes.iloc[-1]
