"""Ledger rows: which batch a run wrote, and how many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebook.layout import BOOK_SUBJECT


def row_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("qtd_registros"))


def batch_control(batch: DataFrame, subject: str, ts_proc: str) -> DataFrame:
    """The ledger row of a raw batch; none for an empty one.

    A batch of sales spans many ``ref``. The row names one that really occurs:
    the latest of the newest file.
    """
    return (
        batch.agg(
            F.max(F.struct("ts_file_generation", "ref")).alias("newest"),
            F.count(F.lit(1)).alias("qtd_registros"),
        )
        .where(F.col("qtd_registros") > 0)
        .select(
            F.lit(subject).alias("assunto"),
            F.col("newest.ref").alias("ref"),
            F.col("newest.ts_file_generation").alias("ts_file_generation"),
            F.lit(int(ts_proc)).alias("ts_proc"),
            "qtd_registros",
        )
    )


def batch_control_row(
    spark: SparkSession, subject: str, ref: str, ts_file_generation: str, ts_proc: str, rows: int
) -> DataFrame:
    """The same row from values already observed while writing the batch."""
    return spark.range(1).select(
        F.lit(subject).alias("assunto"),
        F.lit(ref).cast("string").alias("ref"),
        F.lit(ts_file_generation).cast("string").alias("ts_file_generation"),
        F.lit(int(ts_proc)).alias("ts_proc"),
        F.lit(rows).alias("qtd_registros"),
    )


def book_control_row(spark: SparkSession, ref: str, ts_proc: str, rows: int) -> DataFrame:
    """The ledger row of a feature table; written even for an empty one."""
    return spark.range(1).select(
        F.lit(BOOK_SUBJECT).alias("assunto"),
        F.lit(int(ref)).alias("ref"),
        F.lit(int(ts_proc)).alias("ts_proc"),
        F.lit(rows).alias("qtd_registros"),
    )


def book_control(book: DataFrame, ref: str, ts_proc: str) -> DataFrame:
    """The same row, counting the feature table itself."""
    return row_count(book).select(
        F.lit(BOOK_SUBJECT).alias("assunto"),
        F.lit(int(ref)).alias("ref"),
        F.lit(int(ts_proc)).alias("ts_proc"),
        "qtd_registros",
    )
