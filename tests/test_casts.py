"""Lenient casts agree with plain casts in a session without ANSI mode."""

from __future__ import annotations

from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, TimestampType

from lakebook.functions.casts import lenient
from lakebook.schemas import AMOUNT

NUMBERS = [
    "2", "2.0", "2.7", "-1.9", "", "abc", " 7 ", "+3", "+3.5", "-.5", ".5", ".", "5.", "-", "+",
    "+.", "1e3", "1.2.3", "2.99999999999999999999", "99999999999", "2147483647", "2147483648",
    "-2147483648.9", "0x10", "1,5", "١", "12a", "--3", "3 4", None,
]
AMOUNTS = ["1.005", "1.004", "-1.005", "123456789012.345", "1234567890123", "R$ 5", "", " 3.5 ",
           "1e3", "6.842346E4", ".5", "abc", None]
TIMES = ["2026-04-08 09:49:46", "2026-04-08", "2026-04-08T09:49:46.123", "2026-13-45", "n/a", "",
         "2026-02-30 00:00:00", "2026-04-08 25:00:00", " 2026-04-08 ", None]


def both(spark, values, to):
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    return [
        (r.v, r.mine, r.plain)
        for r in frame.select(
            "v", lenient(F.col("v"), to).alias("mine"), F.col("v").cast(to).alias("plain")
        ).collect()
    ]


def test_whole_numbers(without_ansi):
    for value, mine, plain in both(without_ansi, NUMBERS, IntegerType()):
        assert mine == plain, value


def test_amounts(without_ansi):
    for value, mine, plain in both(without_ansi, AMOUNTS, AMOUNT):
        assert mine == plain, value


def test_timestamps(without_ansi):
    for value, mine, plain in both(without_ansi, TIMES, TimestampType()):
        assert mine == plain, value


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text(alphabet="0123456789+-. eE", max_size=8), min_size=200, max_size=400))
def test_whole_numbers_of_any_text(without_ansi, values):
    for value, mine, plain in both(without_ansi, values, IntegerType()):
        assert mine == plain, repr(value)


def test_bad_values_do_not_fail_under_ansi(spark):
    frame = spark.createDataFrame([("2.7", "1.005", "n/a")], "q string, a string, d string")
    row = frame.select(
        lenient(F.col("q"), IntegerType()),
        lenient(F.col("a"), AMOUNT),
        lenient(F.col("d"), TimestampType()),
    ).first()
    assert tuple(row) == (2, Decimal("1.01"), None)
