import datetime as dt

import pytest
from pyspark.sql import functions as F

from faultline.functions import dates as D


@pytest.mark.parametrize("text, expected", [
    ("2021-01-15", dt.datetime(2021, 1, 15)), ("15-01-2021", dt.datetime(2021, 1, 15)),
    ("15/01/2021", dt.datetime(2021, 1, 15)), ("15.01.2021", dt.datetime(2021, 1, 15)),
    ("2021-01-15 12:30:45", dt.datetime(2021, 1, 15, 12, 30, 45)), ("15-01-2021 12:30:45", dt.datetime(2021, 1, 15, 12, 30, 45)),
    ("15/01/2021 12:30:45", dt.datetime(2021, 1, 15, 12, 30, 45)), (" 15.01.2021 12:30:45 ", dt.datetime(2021, 1, 15, 12, 30, 45)),
    ("01/13/2021", dt.datetime(2021, 1, 13)), ("01/02/2021", dt.datetime(2021, 2, 1)), ("1/13/2021 01:02:03", dt.datetime(2021, 1, 13, 1, 2, 3)),
    ("44211", dt.datetime(2021, 1, 15)), ("44211.5", dt.datetime(2021, 1, 15, 12)), ("0", None), ("100001", None),
    ("00:00:00", None), ("", None), (None, None), ("abc", None), ("31-02-2021", None), ("2021-13-01", None),
])
def test_parse_date(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(D.parse_date("t").cast("timestamp_ntz")).first()[0] == expected


def test_valid_date_rules(spark, rows):
    data = [("1900-01-01 00:00:00",), ("1949-12-31 00:00:00",), ("1950-01-01 00:00:00",), ("2024-06-01 00:00:00",),
            ("2024-06-01 00:00:01",), ("2030-01-01 00:00:00",), (None,)]
    df = spark.createDataFrame(data, "t string").withColumn("ts", F.col("t").cast("timestamp_ntz"))
    kept = rows(df.filter(D.valid_date("ts", 2025, install_cutoff="2024-06-25").isNotNull()), "t")
    assert kept == [("1950-01-01 00:00:00",), ("2024-06-01 00:00:01",)]
    assert df.filter(D.valid_date("ts", 2025).isNotNull()).count() == 3


def test_elapsed_days_round_down(spark):
    df = spark.sql("select timestamp_ntz'2024-01-02 00:00:00' a, timestamp_ntz'2024-01-01 12:00:00' b")
    assert df.select(D.elapsed_days("a", "b"), D.elapsed_days("b", "a")).first()[:] == (-1, 0)


def test_time_only(spark):
    df = spark.createDataFrame([(" 12:30 ",), ("1:02:03",), ("12:3",), ("2021-01-01 12:30",), (None,)], "t string")
    assert [r[0] for r in df.select(D.is_time_only("t")).collect()] == [True, True, False, False, False]


def test_flags_of_missing_dates(spark):
    df = spark.createDataFrame([(None,)], "t timestamp")
    got = df.select(D.summer_flag("t"), D.winter_flag("t"), D.season("t"), D.recency_flag("t", "2024-06-25", 90),
                    D.default_date_flag("t"), D.asset_age_days("t", "2024-06-25"), D.age_source("t", "2024-06-25")).first()
    assert got[:] == (0, 0, None, 0, 0, None, "MISSING")


def test_recency_is_inclusive(spark):
    df = spark.sql("select timestamp_ntz'2024-03-27 00:00:00' a, timestamp_ntz'2024-03-26 23:59:59.999999' b")
    assert df.select(D.recency_flag("a", "2024-06-25", 90), D.recency_flag("b", "2024-06-25", 90)).first()[:] == (1, 0)


def test_stateless_steps_accept_a_stream(spark, tmp_path):
    from faultline.functions import scalars as S
    from faultline.operators import clean

    source = str(tmp_path / "in")
    spark.createDataFrame([(1, "15-01-2021", 500.0), (None, "2021-01-15", 1.0), (2, "junk", None)], "id long, t string, v double") \
        .write.parquet(source)
    stream = spark.readStream.schema("id long, t string, v double").parquet(source)
    shaped = clean.require_id(stream, "id").select("id", D.parse_date("t").alias("ts"), S.voltage_class("v").alias("c"))
    q = shaped.writeStream.format("memory").queryName("shaped").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted((r["id"], r["c"], r["ts"] is None) for r in spark.table("shaped").collect()) == [(1, "AG", False), (2, None, True)]
