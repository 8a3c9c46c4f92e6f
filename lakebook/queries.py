"""Every operator, run over the given tables as seen through ``bindings``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebook import bindings as b
from lakebook.layout import BOOK_CONTROL as BOOK_CONTROL_TABLE
from lakebook.layout import Lake
from lakebook.operators.conform import conform_products, conform_sales
from lakebook.operators.control import batch_control, book_control, row_count
from lakebook.operators.enrich import enrich
from lakebook.operators.recent import lookback, with_flags
from lakebook.operators.snapshot import (
    batch_profile,
    latest_batch,
    newest_version,
    with_version_key,
)
from lakebook.plans.book import book_schema, current_sales, feature_book
from lakebook.plans.jobs import (
    land_snapshot,
    process_products,
    process_sales,
    process_users,
    publish_book,
)
from lakebook.plans.spec import BOOK, FeatureSpec
from lakebook.schemas import BATCH_CONTROL, BOOK_CONTROL, RAW, SALES
from lakebook.session import shared_folder
from lakebook.sources.landing import read_landing, with_lineage
from lakebook.sources.tables import append_batch, read_table
from lakebook.streaming.increment import increment

Query = Callable[[SparkSession, str], DataFrame]

AUGUST = datetime(2001, 8, 1)


def _lake(spark: SparkSession, purpose: str) -> Lake:
    return Lake(shared_folder(spark, purpose))


# Landing


def landing_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = land_snapshot(
        _lake(spark, "csv"), "products", b.products_source(spark, sf_dir), AUGUST
    )
    return read_landing(spark, path)


def landing_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prose with quotes, commas and line breaks, whole."""
    documents = b.table(spark, sf_dir, "documents")
    path = land_snapshot(_lake(spark, "text"), "documents", documents, AUGUST)
    return read_landing(spark, path, multiline=True)


def _land_sales(spark: SparkSession, lake: Lake, sf_dir: str) -> None:
    sales = b.sales_source(spark, sf_dir)
    land_snapshot(lake, "sales", sales.where(F.col("dat_creation") < F.lit(b.JULY)), b.JULY)
    land_snapshot(lake, "sales", sales, AUGUST)


def landing_glob_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, "glob")
    _land_sales(spark, lake, sf_dir)
    return read_landing(spark, lake.landing_glob("sales"))


def file_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, "lineage")
    _land_sales(spark, lake, sf_dir)
    landed = with_lineage(read_landing(spark, lake.landing_glob("sales")), b.RUN_AUG)
    return landed.groupBy("filename", "ref", "ts_file_generation", "ts_proc").agg(
        F.count(F.lit(1)).alias("qtd_registros")
    )


def landing_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs; each reads only the file that landed since the one before."""
    return read_table(spark, _run_increments(spark, sf_dir).raw_increment("sales"), SALES)


def increment_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each of the two runs."""
    ledger = read_table(
        spark, _run_increments(spark, sf_dir).control("sales_increment"), BATCH_CONTROL
    )
    return ledger.select("assunto", "ref", "ts_file_generation", "ts_proc", "qtd_registros")


def _run_increments(spark: SparkSession, sf_dir: str) -> Lake:
    lake = _lake(spark, "increment")
    checkpoint = f"{lake.root}/checkpoint"
    sales = b.sales_source(spark, sf_dir)
    land_snapshot(lake, "sales", sales.where(F.col("dat_creation") < F.lit(b.JULY)), b.JULY, "gzip")
    increment(spark, lake, "sales", b.RUN_JUL, checkpoint)
    land_snapshot(lake, "sales", sales, AUGUST, "gzip")
    increment(spark, lake, "sales", b.RUN_AUG, checkpoint)
    return lake


# Raw rows


def conform_products_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.products_batch(spark, sf_dir)


def conform_users_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.users_batch(spark, sf_dir)


def conform_sales_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.sales_batch(spark, sf_dir)


def conform_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows whose status decides which of their texts are no valid value."""
    status = F.col("o_orderstatus")
    landed = b.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("user_id"),
        F.lit(None).cast("string").alias("product_id"),
        F.when(status == "P", F.col("o_orderpriority"))
        .otherwise(F.col("o_orderdate").cast("string"))
        .alias("dat_creation"),
        F.when(status == "F", F.concat(F.lit("R$ "), F.col("o_totalprice").cast("decimal(14,2)")))
        .otherwise(F.col("o_totalprice").cast("decimal(14,2)").cast("string"))
        .alias("amount"),
        F.when(status == "O", F.concat(F.col("o_custkey"), F.lit(".75")))
        .otherwise(F.col("o_orderpriority"))
        .alias("quantity"),
        F.col("o_orderpriority").alias("payment_method"),
    )
    return conform_sales(b.as_landed(landed, b.FILE_AUG, b.RUN_AUG))


def raw_append_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _lake(spark, "raw").raw("sales")
    append_batch(b.sales_batch(spark, sf_dir), path, spread_by="ref")
    return read_table(spark, path, SALES)


# Batches


def version_key_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_version_key(b.raw_sales(spark, sf_dir), "ts_proc")


def batch_profile_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_profile(b.raw_sales(spark, sf_dir), "ts_proc")


def batch_profile_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_profile(b.raw_products(spark, sf_dir), "ts_file_generation")


def newest_version_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest_version(b.raw_sales(spark, sf_dir), "ts_proc")


def newest_version_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest_version(b.raw_products(spark, sf_dir), "ts_file_generation")


def latest_batch_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_batch(b.raw_sales(spark, sf_dir), "ts_proc")


def latest_run_batch_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As the book selects it, without a look-back."""
    return current_sales(b.raw_sales(spark, sf_dir), b.AS_OF, None)


def latest_batch_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_batch(b.raw_products(spark, sf_dir), "ts_file_generation")


# Filters and joins


def lookback_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookback(b.raw_sales(spark, sf_dir), b.AS_OF)


def recency_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = b.sales_rows(spark, sf_dir)
    return with_flags(enrich(sales, b.products_batch(spark, sf_dir)), b.AS_OF)


def enrich_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(b.sales_rows(spark, sf_dir), b.products_batch(spark, sf_dir))


def _sales_by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales whose product id is their quantity, to meet parts by size."""
    return b.sales_rows(spark, sf_dir).withColumn("product_id", F.col("quantity").cast("string"))


def _parts_by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = b.table(spark, sf_dir, "part").select(
        F.col("p_size").alias("proudct_id"),
        F.col("p_name").alias("product_des"),
        b.renamed("p_type", b.CATEGORIES).alias("product_category"),
    )
    return conform_products(b.as_landed(source, b.FILE_AUG, b.RUN_AUG))


def enrich_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several categories per product id: each sale comes out once for each."""
    products = _parts_by_size(spark, sf_dir).select("product_id", "product_category").distinct()
    return enrich(_sales_by_size(spark, sf_dir), products)


def enrich_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers in place of products: most sales find no match and stay."""
    products = b.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("product_id"),
        F.col("s_name").alias("product_category"),
    )
    return enrich(b.sales_rows(spark, sf_dir), products)


# Features


def _book(
    spark: SparkSession,
    sf_dir: str,
    spec: FeatureSpec = BOOK,
    days: int | None = None,
    mode: str = "two_phase",
) -> DataFrame:
    return feature_book(
        b.raw_sales(spark, sf_dir),
        b.raw_products(spark, sf_dir),
        b.AS_OF,
        b.TS_BOOK,
        spec=spec,
        lookback_days=days,
        mode=mode,
    )


def _statistic(name: str) -> Query:
    spec = BOOK.only(statistics=(name,))
    return lambda spark, sf_dir: _book(spark, sf_dir, spec)


def _dimension(prefix: str) -> Query:
    spec = BOOK.only(dimensions=(prefix,))
    return lambda spark, sf_dir: _book(spark, sf_dir, spec)


def feature_book_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The book with the look-back it is published with."""
    return _book(spark, sf_dir, days=180)


def feature_book_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _book(spark, sf_dir, days=180, mode="direct")


def feature_book_full_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The book over every sale, where the windows really differ."""
    return _book(spark, sf_dir)


def feature_book_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many product rows per id; every one of them counts for each of its sales."""
    return feature_book(
        _sales_by_size(spark, sf_dir),
        _parts_by_size(spark, sf_dir),
        b.AS_OF,
        b.TS_BOOK,
        lookback_days=None,
    )


# Control


def row_count_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(b.raw_sales(spark, sf_dir))


def control_batch_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = b.raw_sales(spark, sf_dir).where(F.col("ts_proc") == b.RUN_AUG)
    return batch_control(run, "sales", b.RUN_AUG)


def control_batch_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_control(b.products_batch(spark, sf_dir), "products", b.RUN_AUG)


def control_batch_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_control(b.users_batch(spark, sf_dir), "users", b.RUN_AUG)


def control_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book_control(feature_book_query(spark, sf_dir), "20010801", b.TS_BOOK)


# Whole jobs


def _run_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Two sales snapshots, one of products and users, two sales runs, one book."""
    lake = _lake(spark, "jobs")
    products = land_snapshot(lake, "products", b.products_source(spark, sf_dir), AUGUST)
    users = land_snapshot(lake, "users", b.users_source(spark, sf_dir), AUGUST)
    sales = b.sales_source(spark, sf_dir)
    land_snapshot(lake, "sales", sales.where(F.col("dat_creation") < F.lit(b.JULY)), b.JULY, "gzip")
    process_sales(spark, lake, b.RUN_JUL)
    land_snapshot(lake, "sales", sales, AUGUST, "gzip")
    process_sales(spark, lake, b.RUN_AUG)
    process_products(spark, lake, products, b.RUN_AUG)
    process_users(spark, lake, users, b.RUN_AUG)
    publish_book(spark, lake, b.AS_OF, b.TS_BOOK)
    return lake


def _published(spark: SparkSession, lake: Lake) -> DataFrame:
    schema = book_schema()
    return read_table(spark, lake.curated(), schema).select(*schema.names)


def curated_publish_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published book, as written by the chain of jobs from landing on."""
    return _published(spark, _run_lake(spark, sf_dir))


def feature_book_from_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The book from sales files that were each read once."""
    lake = _run_increments(spark, sf_dir)
    products = land_snapshot(lake, "products", b.products_source(spark, sf_dir), AUGUST)
    process_products(spark, lake, products, b.RUN_AUG)
    publish_book(spark, lake, b.AS_OF, b.TS_BOOK, increments=True)
    return _published(spark, lake)


def rerun_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over July's file, repeated under its stamp over August's."""
    lake = _lake(spark, "rerun")
    sales = b.sales_source(spark, sf_dir)
    july = land_snapshot(lake, "sales", sales.where(F.col("dat_creation") < F.lit(b.JULY)), b.JULY)
    process_sales(spark, lake, b.RUN_AUG, july)
    process_sales(spark, lake, b.RUN_AUG, land_snapshot(lake, "sales", sales, AUGUST), replace=True)
    return read_table(spark, lake.raw("sales"), SALES)


def users_publish_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, "users")
    users = land_snapshot(lake, "users", b.users_source(spark, sf_dir), AUGUST)
    process_users(spark, lake, users, b.RUN_AUG)
    return read_table(spark, lake.raw("users"), RAW["users"])


def control_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ledger rows that the chain of jobs leaves behind."""
    lake = _run_lake(spark, sf_dir)
    columns = ["assunto", "ref", "ts_file_generation", "ts_proc", "qtd_registros"]
    rows = read_table(spark, lake.control(BOOK_CONTROL_TABLE), BOOK_CONTROL).select(
        "assunto",
        F.col("ref").cast("string").alias("ref"),
        F.lit(None).cast("string").alias("ts_file_generation"),
        "ts_proc",
        "qtd_registros",
    )
    for subject in ("products", "sales", "users"):
        ledger = read_table(spark, lake.control(subject), BATCH_CONTROL)
        rows = rows.unionByName(ledger.select(*columns))
    return rows


QUERIES: dict[str, Query] = {
    "landing_csv_roundtrip": landing_csv_roundtrip,
    "landing_text_roundtrip": landing_text_roundtrip,
    "landing_glob_scan": landing_glob_scan,
    "file_lineage": file_lineage,
    "landing_increment": landing_increment,
    "increment_ledger": increment_ledger,
    "rerun_replaced": rerun_replaced,
    "conform_products": conform_products_query,
    "conform_users": conform_users_query,
    "conform_sales": conform_sales_query,
    "conform_malformed": conform_malformed,
    "raw_append_readback": raw_append_readback,
    "version_key_sales": version_key_sales,
    "batch_profile_sales": batch_profile_sales,
    "batch_profile_products": batch_profile_products,
    "newest_version_sales": newest_version_sales,
    "newest_version_products": newest_version_products,
    "latest_batch_sales": latest_batch_sales,
    "latest_run_batch_sales": latest_run_batch_sales,
    "latest_batch_products": latest_batch_products,
    "lookback_filter": lookback_filter,
    "recency_flags": recency_flags,
    "enrich_category": enrich_category,
    "enrich_fanout": enrich_fanout,
    "enrich_unmatched": enrich_unmatched,
    "cond_count": _statistic("qtd"),
    "cond_sum": _statistic("sum"),
    "cond_avg": _statistic("avg"),
    "cond_min": _statistic("min"),
    "cond_max": _statistic("max"),
    "feature_book_pcat": _dimension("pcat"),
    "feature_book_pm": _dimension("pm"),
    "feature_book": feature_book_query,
    "feature_book_direct": feature_book_direct,
    "feature_book_full_history": feature_book_full_history,
    "feature_book_fanout": feature_book_fanout,
    "feature_book_from_increments": feature_book_from_increments,
    "row_count": row_count_sales,
    "control_batch_sales": control_batch_sales,
    "control_batch_products": control_batch_products,
    "control_batch_users": control_batch_users,
    "control_book": control_book,
    "curated_publish_readback": curated_publish_readback,
    "users_publish_readback": users_publish_readback,
    "control_ledger": control_ledger,
}
