"""Product categories for sales."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What one copy of a broadcast side may weigh on each executor.
BROADCAST_BYTES = 64 * 1024 * 1024
# Headroom per value for the row header, pointers and hash-table slots.
_OVERHEAD = 24


def payload_bytes(rows: DataFrame) -> int:
    """Upper estimate of the memory all ``rows`` take, summed on the cluster."""
    size = reduce(
        add,
        [
            F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)) + _OVERHEAD
            for name in rows.columns
        ],
    )
    return rows.agg(F.sum(size.cast("bigint"))).first()[0] or 0


def small_side(
    rows: DataFrame,
    limit: int = BROADCAST_BYTES,
    bound: DataFrame | None = None,
    known_bytes: int | None = None,
) -> DataFrame:
    """Mark ``rows`` for broadcast if a count of their bytes allows it.

    ``known_bytes`` is a size that the caller vouches for; it saves the job that counts.

    ``bound`` may name rows that are cheaper to count and weigh at least as much.
    Larger sides are left to a shuffled join, where adaptive execution splits the
    partitions of a hot key.
    """
    if known_bytes is not None:
        return F.broadcast(rows) if known_bytes <= limit else rows
    if bound is not None and payload_bytes(bound) <= limit:
        return F.broadcast(rows)
    return F.broadcast(rows) if payload_bytes(rows) <= limit else rows


def enrich(
    sales: DataFrame,
    products: DataFrame,
    limit: int = BROADCAST_BYTES,
    known_bytes: int | None = None,
) -> DataFrame:
    """Every sale with the category of each product row of its ``product_id``.

    Duplicate product ids multiply a sale; a sale without a product stays, with
    a NULL category.
    """
    categories = products.select("product_id", "product_category").where(
        F.col("product_id").isNotNull()
    )
    return sales.join(small_side(categories, limit, known_bytes=known_bytes), "product_id", "left").select(
        *[sales[name] for name in sales.columns], "product_category"
    )
