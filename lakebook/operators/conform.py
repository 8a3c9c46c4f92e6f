"""Landed text to typed raw rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakebook.functions.casts import lenient
from lakebook.functions.stamps import event_ref
from lakebook.schemas import PRODUCTS, SALES, USERS


def conform(
    landed: DataFrame, schema: StructType, taken_from: Mapping[str, Column] | None = None
) -> DataFrame:
    """Give ``landed`` the columns and types of ``schema``, dropping all others.

    A column comes from the landed one of the same name unless ``taken_from``
    says otherwise. Values that do not fit their type become NULL.
    """
    sources = taken_from or {}
    return landed.select(
        [lenient(sources.get(f.name, F.col(f.name)), f.dataType).alias(f.name) for f in schema]
    )


def conform_products(landed: DataFrame) -> DataFrame:
    # Fixed value: the source system's header spells the key this way.
    return conform(landed, PRODUCTS, {"product_id": F.col("proudct_id")})


def conform_users(landed: DataFrame) -> DataFrame:
    return conform(landed, USERS)


def conform_sales(landed: DataFrame) -> DataFrame:
    """Sales are partitioned by the day of the sale, not of the extraction."""
    return conform(landed, SALES, {"ref": event_ref(F.col("dat_creation"))})


CONFORM = {"products": conform_products, "sales": conform_sales, "users": conform_users}
