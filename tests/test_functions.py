"""Value and text semantics on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from cartoria.functions.geo import feature, in_box
from cartoria.functions.text import collapsed, contains_any, first_contained, first_label, folded, html_escaped, irredundant, stripped, valid_rules
from cartoria.functions.values import by_key, first_truthy, nonzero, number, overlay, rounded_exact


def one(spark, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}")


def result(df, column):
    return df.select(column.alias("r")).first()["r"]


def test_three_kinds_of_fallback(spark):
    df = spark.createDataFrame([(None, "", "b", 0.0)], "a string, e string, b string, z double")
    assert result(df, first_truthy(F.col("a"), F.col("e"), F.col("b"))) == "b"
    assert result(df, first_truthy(F.col("a"), F.col("e"))) == ""
    assert result(df, nonzero(F.col("z"))) is None
    assert result(df, overlay(F.col("z"), F.lit(5.0))) == 0.0
    fields = F.from_json(F.lit('{"x": null, "y": "1"}'), "map<string,string>")
    assert result(df, by_key(fields, "x", "y", default=F.lit("d"))) is None
    assert result(df, by_key(fields, "absent", "y", default=F.lit("d"))) == "1"
    assert result(df, by_key(fields, "absent", default=F.lit("d"))) == "d"


@pytest.mark.parametrize(("text", "value"), [("12.5", 12.5), (" -3 ", -3.0), ("12.5d", None), ("abc", None), ("", None), (None, None), ("NaN", None), ("1e2", 100.0), ("1_0", None)])
def test_numbers(spark, text, value):
    assert result(one(spark, text), number(F.col("v"))) == value


def test_rounding_is_that_of_the_binary_value(spark):
    values = [-38.4567895, 1.0000005, 2.5, float("nan"), None]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(rounded_exact("v")).collect()]
    assert got[:3] == [round(v, 6) for v in values[:3]]
    assert got[3] is None and got[4] is None


@pytest.mark.parametrize("text", ["  a  b ", " a b ", "\ta\nb\r\n", "", None, "　"])
def test_white_space(spark, text):
    want = text.strip() if text is not None else None
    assert result(one(spark, text), stripped(F.col("v"))) == want
    assert result(one(spark, text), collapsed(F.col("v"))) == (" ".join(text.split()) if text is not None else None)


def test_case(spark):
    assert result(one(spark, "STRAßE É"), folded(F.col("v"))) == "strasse é"


def test_terms(spark):
    assert irredundant(["Axé", "axé", "axé beach", "mercad", "mercadinho"]) == ["axé", "mercad"]
    df = spark.createDataFrame([("Mercadinho do AXÉ",), ("x.y",), (None,), ("",)], "v string")
    assert [r[0] for r in df.select(contains_any(F.col("v"), ["axé", "a.b"])).collect()] == [True, False, None, False]
    assert [r[0] for r in df.select(contains_any(F.col("v"), ["x.y"])).collect()] == [False, True, None, False]
    assert [r[0] for r in df.select(first_contained(F.col("v"), ["mercadinho", "mercad"])).collect()] == ["mercadinho", None, None, None]
    assert result(one(spark, "a"), contains_any(F.col("v"), [])) is False


def test_rules_keep_order_and_quarantine(spark):
    with pytest.warns(UserWarning, match="ruim"):
        good, bad = valid_rules(spark, [("um", "bar"), ("ruim", "a|(b"), ("dois", r"\bbar\b")])
    assert [g[0] for g in good] == ["um", "dois"] and bad == [("ruim", "a|(b")]
    df = spark.createDataFrame([("baré",), ("BAR",), (None,)], "v string")
    assert [r[0] for r in df.select(first_label(F.col("v"), [("palavra", r"\bbar\b"), ("parte", "bar")])).collect()] == ["parte", "palavra", None]


def test_html(spark):
    assert result(one(spark, "<a & 'b' \"c\">"), html_escaped(F.col("v"))) == "&lt;a &amp; &#39;b&#39; &quot;c&quot;&gt;"


@pytest.mark.parametrize(("lat", "lng", "inside"), [(-18.5, -47.0, True), (-8.0, -37.0, True), (-7.99, -40.0, False), (None, -40.0, False), (float("nan"), -40.0, False)])
def test_box(spark, lat, lng, inside):
    df = spark.createDataFrame([(lat, lng)], "lat double, lng double")
    assert result(df, in_box(F.col("lat"), F.col("lng"))) is inside


def test_feature(spark):
    df = spark.createDataFrame([(-10.0, -40.0, "x")], "lat double, lng double, nome string")
    f = result(df, feature(F.col("lat"), F.col("lng"), F.struct("nome")))
    assert f["geometry"]["coordinates"] == [-40.0, -10.0] and f["properties"]["nome"] == "x"
