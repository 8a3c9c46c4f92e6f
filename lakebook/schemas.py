"""Stored schemas: raw tables, the ledger, and the partition columns they share."""

from __future__ import annotations

from pyspark.sql.types import (
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

AMOUNT = DecimalType(14, 2)
AMOUNT_SUM = DecimalType(24, 2)
AMOUNT_AVG = DecimalType(18, 6)

PARTITIONS = ("ref", "ts_proc")


def _text(*names: str) -> list[StructField]:
    return [StructField(name, StringType()) for name in names]


# The column names and types of the stored tables.
# ``ref`` and ``ts_proc`` are declared as text. Left to inference they come back
# as numbers, until one malformed folder name turns the whole column into text.
PRODUCTS = StructType(
    _text(
        "ref",
        "ts_file_generation",
        "ts_proc",
        "product_id",
        "product_des",
        "product_category",
    )
)

USERS = StructType(
    _text(
        "ref",
        "ts_file_generation",
        "ts_proc",
        "user_id",
        "first_name",
        "last_name",
        "gender",
        "email",
    )
)

SALES = StructType(
    _text("ref", "ts_proc", "ts_file_generation", "transaction_id", "user_id", "product_id")
    + [
        StructField("dat_creation", TimestampType()),
        StructField("amount", AMOUNT),
        StructField("quantity", IntegerType()),
    ]
    + _text("payment_method")
)

RAW = {"products": PRODUCTS, "sales": SALES, "users": USERS}

# Counts are written as int while they fit and as bigint beyond; bigint reads both.
BATCH_CONTROL = StructType(
    _text("assunto", "ts_file_generation")
    + [StructField("ts_proc", LongType()), StructField("qtd_registros", LongType())]
    + _text("ref")
)
BOOK_CONTROL = StructType(
    _text("assunto")
    + [
        StructField("ts_proc", LongType()),
        StructField("qtd_registros", LongType()),
        StructField("ref", IntegerType()),
    ]
)
