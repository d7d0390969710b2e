import pytest
from pyspark.sql import functions as F

from faultline import config
from faultline.functions import scalars as S


def one(spark, column, **values):
    types = {int: "bigint", float: "double", str: "string", type(None): "double", bool: "boolean"}
    schema = ", ".join(f"{k} {types[type(v)]}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column).first()[0]


@pytest.mark.parametrize("value, label", [
    (-1.0, None), (0.0, None), (0.4, "Low (0-40%)"), (0.4000001, "Medium (40-70%)"), (0.7, "Medium (40-70%)"),
    (1.0, "High (70-100%)"), (1.5, "Critical (>100%)"), (float("nan"), None), (None, None)])
def test_cut_is_right_closed(spark, value, label):
    assert one(spark, S.cut("x", *config.AGE_RISK_BINS), x=value) == label


def test_cut_can_include_the_lowest(spark):
    assert one(spark, S.cut("x", *config.RISK_BINS, include_lowest=True), x=0.0) == "DÜŞÜK"
    assert one(spark, S.cut("x", *config.RISK_BINS, include_lowest=True), x=100.1) is None


def test_ratio(spark):
    assert one(spark, S.ratio_plus1(["a"], "t"), a=5.0, t=None) == 1.0
    assert one(spark, S.ratio_plus1(["a"], "t"), a=5.0, t=9.0) == 0.5
    assert one(spark, S.ratio_plus1(["a"], "t"), a=None, t=0.0) == 0.0
    assert one(spark, S.ratio_plus1_of_means(["a"], "t"), a=5.0, t=None) is None


@pytest.mark.parametrize("text, name", [("Kesici Arızaları", "Kesici"), (" Trafo Arızası ", "Trafo"), ("Hat Ariza", "Hat"), ("Bina", "Bina"), (None, None)])
def test_extract_class(spark, text, name):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(S.extract_class("t")).first()[0] == name


@pytest.mark.parametrize("name, life", [("Kesici", 30), (" Bina ", 40), ("OG Sigorta", 30), ("YG X", 35), ("Direk", 25), (None, 25)])
def test_expected_life(spark, name, life):
    df = spark.createDataFrame([(name,)], "t string")
    assert df.select(S.expected_life("t")).first()[0] == life


def test_harmonize(spark):
    df = spark.createDataFrame([("SDK",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(S.harmonize("t")).collect()] == ["AG Pano Box", "x", None]


@pytest.mark.parametrize("volts, label", [(None, None), (400.0, "AG"), (1000.0, "Bilinmeyen"), (10000.0, "OG"), (36000.0, "YG")])
def test_voltage(spark, volts, label):
    assert one(spark, S.voltage_class("v"), v=volts) == label


def test_guards(spark):
    assert one(spark, S.reliability_score("m"), m=None) == 0.0
    assert one(spark, S.reliability_score("m"), m=730.0) == 100.0
    assert one(spark, S.failure_free("n"), n=None) == 0
    assert one(spark, S.overdue_factor("d", "m", "n"), d=10, m=0.0, n=3) is None
    assert one(spark, S.mtbf_trend("d", "m", "n"), d=None, m=5.0, n=4) == 1.0
    assert one(spark, S.mtbf_trend("d", "m", "n"), d=10.0, m=5.0, n=3) is None
    assert one(spark, S.mtbf_variability("a", "b", "n"), a=None, b=5.0, n=2) == 0.0
    assert one(spark, S.loading_score("d"), d=None) == pytest.approx(1 / 366)
    assert one(spark, S.loading_score("d"), d=-5) == 1.0
    assert one(spark, S.risk_score("p"), p=None) is None
    assert one(spark, S.risk_score("p"), p=1.5) == 100.0
    assert one(spark, S.finite("p"), p=float("inf")) is None
    assert one(spark, S.row_mean(["a", "b"]), a=2.0, b=None) == 2.0
    assert one(spark, S.combine("a", "b"), a="x", b=None) == "x_nan"
    assert one(spark, S.to_number("a"), a="x1") is None


def test_cause_flags(spark):
    df = spark.createDataFrame([(None, 3, "a", None)], "c double, d int, f string, l string")
    assert df.select(*[v.alias(k) for k, v in S.cause_flags("c", "d", "f", "l").items()]).first()[:] == (0, 1, 1)


def test_region(spark):
    df = spark.createDataFrame([("salihli",), ("X",), (None,)], "d string")
    assert [r[0] for r in df.select(S.region_type("d")).collect()] == ["Kentsel", "Kırsal", "Kırsal"]


def test_healthy_mask_falls_back(spark):
    df = spark.createDataFrame([(None, 3.0)], "days_since_last double, x double")
    assert df.select(S.healthy_mask(df.columns)).first()[0] is True
    assert df.select(S.healthy_mask(["x"])).first()[0] is False
    assert df.withColumn("data_source", F.lit("Healthy_Equipment")).select(S.healthy_mask(["data_source"])).first()[0] is True
