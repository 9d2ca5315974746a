from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shopweave import functions as fn


def apply(spark, function, *inputs, kind="string"):
    schema = ", ".join(f"c{i} {kind}" for i in range(len(inputs)))
    frame = spark.createDataFrame([tuple(inputs)], schema)
    return frame.select(function(*(F.col(c) for c in frame.columns)).alias("x")).first().x


@pytest.mark.parametrize(
    "text, number",
    [("12", 12), (" 12abc", 12), ("abc", 0), ("", 0), (None, 0), ("12.9", 12), ("9" * 30, 0)],
)
def test_to_unsigned(spark, text, number):
    assert apply(spark, fn.to_unsigned, text) == number


@pytest.mark.parametrize(
    "text, number",
    [
        ("12.5", "12.5"),
        ("12.5abc", "12.5"),
        ("-3.25", "-3.25"),
        (".5", "0.5"),
        ("", "0"),
        (None, "0"),
        ("x1", "0"),
        ("9" * 40, "0"),
    ],
)
def test_to_decimal(spark, text, number):
    assert apply(spark, fn.to_decimal, text) == Decimal(number)


def test_to_decimal_keeps_the_money_type(spark):
    frame = spark.createDataFrame([("1",)], "c string")
    assert frame.select(fn.to_decimal(F.col("c"))).schema[0].dataType.simpleString() == "decimal(26,8)"


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata"])
def test_from_unixtime_ignores_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert apply(spark, fn.from_unixtime, "1700000000") == datetime(2023, 11, 14, 22, 13, 20)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("text", [None, "", "soon", "-5", "99999999999999999"])
def test_from_unixtime_without_a_moment(spark, text):
    assert apply(spark, fn.from_unixtime, text) is None


def test_flags(spark):
    assert [apply(spark, fn.yes_flag, t) for t in ("yes", "no", "YES", None)] == [1, 0, 0, 0]
    assert [apply(spark, fn.true_flag, t) for t in ("true", "yes", None)] == [1, 0, 0]


def test_status_prefix_rules_differ(spark):
    rules = (fn.strip_status_all, fn.strip_status_prefix, fn.strip_status_substr)
    assert [apply(spark, r, "wc-xwc-y") for r in rules] == ["xy", "xwc-y", "xwc-y"]
    assert [apply(spark, r, "trash") for r in rules] == ["trash", "trash", "sh"]


def test_percentages(spark):
    assert apply(spark, fn.round_pct, 1, 3, kind="bigint") == 33.33
    assert apply(spark, fn.int_pct, 2, 3, kind="bigint") == 66
    assert apply(spark, fn.int_pct, 2, 0, kind="bigint") is None
    assert apply(spark, fn.round_pct, 2, 0, kind="bigint") is None


def test_text_rules(spark):
    assert apply(spark, fn.clean_text, 'a\nb\r\nc\t"d"') == 'a b  c "d"'
    assert apply(spark, fn.price_fallback, None, "5") == "5"
    assert apply(spark, fn.price_fallback, None, None) == "0"
    assert apply(spark, lambda p: fn.image_url("shop.example.com", p), None) is None


def test_product_type_prefers_30days(spark):
    kinds = [
        apply(spark, fn.product_type, *flags, kind="boolean")
        for flags in [(True, True), (True, False), (False, False), (None, None)]
    ]
    assert kinds == ["30days", "buynow", "30days", "30days"]
