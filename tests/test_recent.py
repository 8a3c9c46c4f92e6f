from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from lakebook.functions.recency import band, whole_months
from lakebook.operators.recent import lookback, with_flags

RUN = date(2026, 4, 8)


def refs(spark, values):
    return spark.createDataFrame([(v,) for v in values], "ref string")


def kept(frame):
    return sorted(r.ref for r in frame.collect())


def test_lookback_edges(spark):
    day = lambda n: (RUN - timedelta(days=n)).strftime("%Y%m%d")
    frame = refs(spark, [day(180), day(181), day(0), day(-400), None, "n/a", "20261345", "2026 "])
    assert kept(lookback(frame, RUN)) == sorted([day(180), day(0), day(-400), "20261345"])


def test_no_lookback_keeps_everything(spark):
    values = ["19000101", "20260408", None, "n/a"]
    assert lookback(refs(spark, values), RUN, None).count() == 4


def test_lookback_on_inferred_numbers(spark):
    frame = spark.createDataFrame([(20260101,), (20200101,)], "ref int")
    assert [r.ref for r in lookback(frame, RUN).collect()] == [20260101]


@pytest.mark.parametrize(
    ("run", "ref", "months"),
    [
        (date(2026, 2, 28), "20260131", 1),
        (date(2026, 2, 28), "20260130", 0),
        (date(2026, 2, 28), "20260128", 1),
        (date(2026, 4, 8), "20260408", 0),
        (date(2026, 4, 8), "20260209", 1),
        (date(2026, 4, 8), "20260208", 2),
        (date(2026, 4, 8), "20260609", -2),
        (date(2026, 4, 8), "20261345", None),
        (date(2026, 4, 8), "n/a", None),
        (date(2026, 4, 8), None, None),
    ],
)
def test_whole_months(spark, run, ref, months):
    assert refs(spark, [ref]).select(whole_months(run, F.col("ref"))).first()[0] == months


def test_bands_are_nested(spark):
    ages = [-5, 0, 1, 2, 3, 4, 6, 7, None]
    frame = spark.createDataFrame([(a,) for a in ages], "age int")
    got = [r[0] for r in frame.select(band(F.col("age"), [1, 3, 6])).collect()]
    assert got == [0, 0, 0, 1, 1, 2, 2, 3, 3]


def test_flags(spark):
    frame = spark.createDataFrame(
        [("20260408",), ("20260101",), ("20251101",), ("20250101",), ("20270101",), ("20261345",)],
        "ref string",
    )
    for name in ("transaction_id", "user_id", "product_category", "payment_method"):
        frame = frame.withColumn(name, F.lit("x"))
    frame = frame.withColumn("dat_creation", F.lit(None)).withColumn("amount", F.lit(1))
    flags = with_flags(frame.withColumn("quantity", F.lit(1)), RUN)
    assert flags.columns == [
        "transaction_id", "user_id", "ref", "product_category", "dat_creation", "amount",
        "payment_method", "flag_u1m", "flag_u3m", "flag_u6m",
    ]
    assert {r.ref: (r.flag_u1m, r.flag_u3m, r.flag_u6m) for r in flags.collect()} == {
        "20260408": (1, 1, 1),
        "20260101": (0, 1, 1),
        "20251101": (0, 0, 1),
        "20250101": (0, 0, 0),
        "20270101": (1, 1, 1),
        "20261345": (0, 0, 0),
    }
