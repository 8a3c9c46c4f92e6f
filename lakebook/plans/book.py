"""The feature book: one row of 160 features per user."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lakebook.functions.recency import whole_months
from lakebook.layout import checked_stamp, day
from lakebook.operators.enrich import BROADCAST_BYTES, enrich, small_side
from lakebook.operators.features import KEY, assemble, cell, compact, direct
from lakebook.operators.recent import LOOKBACK_DAYS, lookback
from lakebook.operators.snapshot import latest_batch
from lakebook.plans.spec import BOOK, FeatureSpec
from lakebook.schemas import AMOUNT, AMOUNT_AVG, AMOUNT_SUM

CATEGORY = "product_category"


def current_sales(
    raw_sales: DataFrame, as_of: date, lookback_days: int | None, lead: str = "ts_proc"
) -> DataFrame:
    """Newest batch among those with a sale inside the look-back (None: of any age).

    The look-back comes first, so a newer batch that lies wholly outside it does
    not hide an older one.
    """
    return latest_batch(lookback(raw_sales, as_of, lookback_days), lead=lead)


def current_products(raw_products: DataFrame) -> DataFrame:
    """Newest batch by file; the run stamp only breaks ties."""
    return latest_batch(raw_products, lead="ts_file_generation")


def _product_copies(
    products: DataFrame, spec: FeatureSpec, limit: int, known_bytes: int | None
) -> DataFrame:
    """Per product id and category cell, how many product rows there are.

    Joining these in place of the product rows gives the same statistics without
    emitting a sale once per duplicate: a sale meets at most one row per cell,
    however many rows its product id has.
    """
    narrow = products.where(F.col("product_id").isNotNull()).select(
        "product_id",
        *[cell(spec, d).alias(f"cell_{d.prefix}") for d in spec.dimensions if d.column == CATEGORY],
    )
    copies = narrow.groupBy(*narrow.columns).agg(F.count(F.lit(1)).alias("copies"))
    # Ungrouped, they take a scan to count; grouping decides only if that is too much.
    return small_side(
        copies, limit, bound=narrow.withColumn("copies", F.lit(1)), known_bytes=known_bytes
    )


def two_phase(
    sales: DataFrame,
    products: DataFrame,
    as_of: date,
    spec: FeatureSpec,
    limit: int,
    known_bytes: int | None = None,
) -> DataFrame:
    narrow = sales.select(
        KEY,
        "product_id",
        "amount",
        whole_months(as_of, F.col("ref")).alias("age"),
        *[
            cell(spec, d).alias(f"cell_{d.prefix}")
            for d in spec.dimensions
            if d.column != CATEGORY
        ],
    )
    copies = _product_copies(products, spec, limit, known_bytes)
    joined = narrow.join(copies, "product_id", "left").withColumn(
        "copies", F.coalesce("copies", F.lit(1))
    )
    return assemble(compact(joined, spec), spec)


def literal(
    sales: DataFrame,
    products: DataFrame,
    as_of: date,
    spec: FeatureSpec,
    limit: int,
    known_bytes: int | None = None,
) -> DataFrame:
    enriched = enrich(sales, products, limit, known_bytes)
    return direct(enriched.withColumn("age", whole_months(as_of, F.col("ref"))), spec)


_TYPES = {"qtd": LongType(), "sum": AMOUNT_SUM, "avg": AMOUNT_AVG, "min": AMOUNT, "max": AMOUNT}


def book_schema(spec: FeatureSpec = BOOK) -> StructType:
    """The declared schema of the stored book; its stamps are text, as in raw tables."""
    text = [StructField(name, StringType()) for name in (KEY, "ref", "ts_proc")]
    return StructType(text + [StructField(f.name, _TYPES[f.statistic]) for f in spec.features()])


MODES = {"two_phase": two_phase, "direct": literal}


def feature_book(
    raw_sales: DataFrame,
    raw_products: DataFrame,
    as_of: date,
    ts_proc: str,
    *,
    spec: FeatureSpec = BOOK,
    lookback_days: int | None = LOOKBACK_DAYS,
    mode: str = "two_phase",
    broadcast_limit: int = BROADCAST_BYTES,
    products_bytes: int | None = None,
    sales_lead: str = "ts_proc",
) -> DataFrame:
    """Features of every user with a sale in the look-back, as of one day.

    ``lookback_days`` None takes sales of any age. ``products_bytes``, if known, saves
    counting the products before they are broadcast. ``sales_lead`` is the stamp that
    decides which batch of sales is the current table.

    Both modes give the same table; ``direct`` is the plain statement of it,
    ``two_phase`` the one to run on large data.
    """
    features = MODES[mode](
        current_sales(raw_sales, as_of, lookback_days, sales_lead),
        current_products(raw_products),
        as_of,
        spec,
        broadcast_limit,
        products_bytes,
    )
    return features.selectExpr(
        KEY,
        f"'{day(as_of)}' as ref",
        f"'{checked_stamp(ts_proc)}' as ts_proc",
        f"* except ({KEY})",
    )
