"""Look-back filter and recency flags."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakebook.functions.recency import whole_months, within
from lakebook.layout import day

# Look-back in days, and flag names with their months.
LOOKBACK_DAYS = 180
FLAGS = {"flag_u1m": 1, "flag_u3m": 3, "flag_u6m": 6}


def first_ref(as_of: date, days: int | None = LOOKBACK_DAYS) -> int | None:
    """The oldest ``ref`` inside the look-back, as a number; None if there is no look-back."""
    return None if days is None else int(day(as_of - timedelta(days=days)))


def lookback(rows: DataFrame, as_of: date, days: int | None = LOOKBACK_DAYS) -> DataFrame:
    """Keep rows whose ``ref`` is at most ``days`` before ``as_of``; None keeps all.

    ``ref`` is compared as a number: folders that are no number are dropped, and
    there is no upper bound, so future dates stay. On a table partitioned by
    ``ref`` this is a partition filter: files of other folders are listed, as for any
    read of the whole table, but not opened. ``read_table`` can skip listing them.
    """
    first = first_ref(as_of, days)
    return rows if first is None else rows.where(F.col("ref").try_cast("bigint") >= first)


def with_flags(rows: DataFrame, as_of: date) -> DataFrame:
    """The columns the feature table needs, with one 1/0 flag per window."""
    aged = rows.withColumn("age", whole_months(as_of, F.col("ref")))
    return aged.select(
        "transaction_id",
        "user_id",
        "ref",
        "product_category",
        "dat_creation",
        "amount",
        "payment_method",
        *[within(F.col("age"), months).alias(flag) for flag, months in FLAGS.items()],
    )
