from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as c


def one(spark, expr, value, kind):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr.alias("y")).first().y


@pytest.mark.parametrize(
    "value, want", [("1.159", "1.15"), ("-1.159", "-1.15"), ("0.005", "0.00"), ("7", "7.00"), (None, None)]
)
def test_money_drops_digits(spark, value, want):
    got = one(spark, c.money("x"), None if value is None else Decimal(value), "decimal(18,3)")
    assert got == (None if want is None else Decimal(want))


@pytest.mark.parametrize(
    "value, want",
    [
        ("1.1599999996", "1.15"), ("-0.0099999999", "0.00"), ("-1.1599999996", "-1.15"), (" 12 ", "12.00"), ("1.999999999999999999999999", "1.99"),
        ("1.5e1", "15.00"), (".5", "0.50"), ("abc", None), ("", None), ("9e30", None), ("-9999999999999999.999", "-9999999999999999.99"),
    ],
)
def test_money_of_text(spark, value, want):
    assert one(spark, c.money("x"), value, "string") == (None if want is None else Decimal(want))


@pytest.mark.parametrize("value, want", [(1.15, "1.15"), (2.675, "2.67"), (-0.019, "-0.01")])
def test_money_of_doubles(spark, value, want):
    assert one(spark, c.money("x"), value, "double") == Decimal(want)


@pytest.mark.parametrize(
    "value, want",
    [(None, None), ("", "****"), ("1", "1****1"), ("+34 612345678", "+34 61****78"), ("12345678", "123456****78")],
)
def test_mask_phone(spark, value, want):
    assert one(spark, c.mask_phone("x"), value, "string") == want


def test_email_digest_ignores_case_and_blanks(spark):
    a = one(spark, c.email_digest("x"), " Ana@Example.com ", "string")
    assert a == one(spark, c.email_digest("x"), "ana@example.com", "string")
    assert len(a) == 64


@pytest.mark.parametrize("day, want", [(date(2024, 1, 1), 1), (date(2024, 1, 6), 6), (date(2024, 1, 7), 7)])
def test_iso_weekday(spark, day, want):
    assert one(spark, c.iso_weekday("x"), day, "date") == want


def test_pad_key_keeps_long_numbers(spark):
    assert one(spark, c.pad_key("A-", "x", 4), 7, "bigint") == "A-0007"
    assert one(spark, c.pad_key("A-", "x", 4), 123456, "bigint") == "A-123456"


@pytest.mark.parametrize(
    "num, den, want",
    [("1.00", "3.00", 0.3333), ("2.00", "3.00", 0.6667), ("-2.00", "3.00", -0.6667), ("0.05", "1000.00", 0.0001), ("-0.05", "1000.00", -0.0001), ("1.00", "0.00", None)],
)
def test_ratio4(spark, num, den, want):
    df = spark.createDataFrame([(Decimal(num), Decimal(den))], "a decimal(18,2), b decimal(18,2)")
    assert df.select(c.ratio4(c.cents("a"), c.cents("b")).alias("y")).first().y == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("2024-02-03 04:05:06.789", datetime(2024, 2, 3, 4, 5, 6)),
        ("2024-02-03T04:05:06Z", datetime(2024, 2, 3, 4, 5, 6)),
        ("2024-02-03", datetime(2024, 2, 3)),
        ("2024/02/03 04:05:06", datetime(2024, 2, 3, 4, 5, 6)),
        ("03/02/2024", datetime(2024, 2, 3)),
        ("20240203", datetime(2024, 2, 3)),
        ("20240203040506", datetime(2024, 2, 3, 4, 5, 6)),
        ("1706933106", datetime(2024, 2, 3, 4, 5, 6)),
        ("no date", None),
        (None, None),
    ],
)
def test_timestamp_of_text(spark, text, want):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(c.timestamp_of(df, "x").alias("y")).first().y == want


def test_surrogate_is_null_with_a_null_part(spark):
    df = spark.createDataFrame([("a", None)], "x string, y date")
    assert df.select(c.surrogate("x", "y").alias("k")).first().k is None


@pytest.mark.parametrize("value, want", [("a", True), (" ", False), ("", False), (None, False)])
def test_has_text(spark, value, want):
    df = spark.createDataFrame([(value,)], "x string")
    assert df.where(c.has_text("x")).count() == int(want)
