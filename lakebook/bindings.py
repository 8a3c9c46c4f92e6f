"""The given star-schema tables seen as the lake's sources and raw tables.

Order lines stand in for sales, parts for products, customers for users. Nothing
is generated or left out; only names, stamps and category labels are assigned.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebook.operators.conform import conform_products, conform_sales, conform_users
from lakebook.schemas import SALES

AS_OF = date(2001, 8, 1)
TS_BOOK = "20010801030000"

# Four part types and four priorities take the place of the book's listed values;
# the others keep their names and so are counted nowhere.
CATEGORIES = {
    "STANDARD": "Livros",
    "LARGE": "Roupas",
    "MEDIUM": "Eletronicos",
    "ECONOMY": "Jogos",
}
PAYMENTS = {
    "5-LOW": "Cartao Debito",
    "4-NOT SPECIFIED": "PIX",
    "3-MEDIUM": "Cartao Credito",
    "2-HIGH": "Boleto",
}

# (file stamp, run stamp) pairs, in the order the runs happened. Every sales run
# reads all files so far; the products file of June is read again in August.
FILE_JUL, FILE_AUG = "20010701000000", "20010801000000"
RUN_JUL, RUN_AUG, RUN_LATE = "20010701010000", "20010801010000", "20010802010000"
SALES_RUNS = ((FILE_JUL, RUN_JUL), (FILE_JUL, RUN_AUG), (FILE_AUG, RUN_AUG))
PRODUCT_RUNS = ((FILE_JUL, RUN_JUL), (FILE_AUG, RUN_AUG), (FILE_JUL, RUN_LATE))
JULY = datetime(2001, 7, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def renamed(column: str, names: dict[str, str]) -> Column:
    """The column with the values in ``names`` replaced, others as they are."""
    value = F.col(column)
    for old, new in names.items():
        value = F.when(F.col(column) == old, new).otherwise(value)
    return value


def sales_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales table of the source system; ``status`` is not wanted downstream."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_orderdate").alias("dat_creation"),
        F.col("l_extendedprice").cast("decimal(14,2)").alias("amount"),
        F.col("l_quantity").alias("quantity"),
        renamed("o_orderpriority", PAYMENTS).alias("payment_method"),
        F.col("o_orderstatus").alias("status"),
    )


def products_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("proudct_id"),
        F.col("p_name").alias("product_des"),
        renamed("p_type", CATEGORIES).alias("product_category"),
        F.col("p_brand").alias("brand"),
    )


def users_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.split("c_name", "#")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.get(name, F.lit(0)).alias("first_name"),
        F.get(name, F.lit(1)).alias("last_name"),
        F.col("c_mktsegment").alias("gender"),
        F.concat(F.lower(F.get(name, F.lit(1))), F.lit("@example.org")).alias("email"),
    )


def as_landed(source: DataFrame, file_stamp: str, ts_proc: str) -> DataFrame:
    """A source table as text with its stamps, as if landed and read back."""
    return source.select(
        [F.col(name).cast("string").alias(name) for name in source.columns]
        + [
            F.lit(file_stamp[:8]).alias("ref"),
            F.lit(file_stamp).alias("ts_file_generation"),
            F.lit(ts_proc).alias("ts_proc"),
        ]
    )


def sales_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch of sales, conformed from text."""
    return conform_sales(as_landed(sales_source(spark, sf_dir), FILE_AUG, RUN_AUG))


def sales_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batch as a raw table holds it, already typed."""
    source = sales_source(spark, sf_dir)
    typed = {
        "ref": F.date_format("dat_creation", "yyyyMMdd"),
        "ts_proc": F.lit(RUN_AUG),
        "ts_file_generation": F.lit(FILE_AUG),
    }
    return source.select(
        [typed.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in SALES]
    )


def products_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform_products(as_landed(products_source(spark, sf_dir), FILE_AUG, RUN_AUG))


def users_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform_users(as_landed(users_source(spark, sf_dir), FILE_AUG, RUN_AUG))


def _repeated(batch: DataFrame, runs: tuple[tuple[str, str], ...]) -> DataFrame:
    """One copy of each row per (file stamp, run stamp) pair, in a single scan."""
    pairs = F.array(*[F.struct(F.lit(f).alias("f"), F.lit(r).alias("r")) for f, r in runs])
    return (
        batch.withColumn("run", F.explode(pairs))
        .withColumn("ts_file_generation", F.col("run.f"))
        .withColumn("ts_proc", F.col("run.r"))
        .drop("run")
    )


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches; files of July lack the sales of July."""
    batches = _repeated(sales_rows(spark, sf_dir), SALES_RUNS)
    return batches.where(
        (F.col("ts_file_generation") == FILE_AUG) | (F.col("dat_creation") < F.lit(JULY))
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches; the file of July knows no categories yet."""
    batches = _repeated(products_batch(spark, sf_dir), PRODUCT_RUNS)
    return batches.withColumn("ref", F.substring("ts_file_generation", 1, 8)).withColumn(
        "product_category",
        F.when(F.col("ts_file_generation") == FILE_AUG, F.col("product_category")),
    )
