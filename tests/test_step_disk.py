"""What a step of the chain leaves on disk beside its result."""

from __future__ import annotations

import os
import time
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakebook.plans.jobs import land_snapshot, process_sales
from lakebook.schemas import SALES
from lakebook.sources.landing import read_landing, with_lineage
from lakebook.sources.runs import landed_files
from lakebook.sources.tables import read_table
from lakebook.streaming.increment import increment

WHEN = datetime(2026, 4, 8, 9, 49, 46)
RUN = "20260409010000"


def shuffle_files(spark) -> set[str]:
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {name for top in local for _, _, names in os.walk(top.getPath()) for name in names if name.startswith("shuffle_")}


def left_by(spark, before: set[str]) -> set[str]:
    for _ in range(50):  # Spark deletes them beside
        if not (left := shuffle_files(spark) & before):
            break
        time.sleep(0.1)
    return left


def sales(spark):
    """Rows that are shuffled before they are landed."""
    keys = spark.range(500).select(
        F.col("id").alias("transaction_id"),
        (F.col("id") % 7).alias("user_id"),
        F.concat(F.lit("p-"), F.col("id") % 5).alias("product_id"),
        F.date_add(F.lit("2026-04-01"), (F.col("id") % 6).cast("int")).alias("dat_creation"),
        F.lit(2.5).alias("amount"),
        F.lit(1).alias("quantity"),
        F.lit("PIX").alias("payment_method"),
        F.lit("O").alias("status"),
    )
    return keys.repartition(4, "user_id")


@pytest.mark.parametrize("step", ["land", "process"])
def test_the_next_step_goes_on_without_a_step_s_shuffle_files(spark, lake, step):
    source = sales(spark)
    there = shuffle_files(spark)
    land_snapshot(lake, "sales", source, WHEN)
    if step == "process":
        assert process_sales(spark, lake, RUN).rows == 500
    own = shuffle_files(spark) - there
    spark.range(1).collect()  # the session holds the plan that ran last
    time.sleep(2)  # and its listeners and the gateway others, for a while
    land_snapshot(lake, "users", spark.range(1), WHEN)
    assert left_by(spark, own) == set()


def test_packed_parts_hold_the_same_rows(spark, lake):
    source = sales(spark)
    plain = land_snapshot(lake, "plain", source, WHEN)
    packed = land_snapshot(lake, "sales", source, WHEN, "gzip")

    def size(path):
        return sum(p.stat().st_size for p in Path(path).glob("part-*"))

    assert {"".join(p.suffixes) for p in Path(packed).glob("part-*")} == {".csv.gz"}
    assert size(packed) < size(plain) / 2
    rows = [read_landing(spark, path) for path in (plain, packed)]
    assert rows[0].columns == rows[1].columns
    assert sorted(map(tuple, rows[0].collect())) == sorted(map(tuple, rows[1].collect()))
    names = with_lineage(rows[1], RUN).select("filename", "ref", "ts_file_generation").distinct().collect()
    assert [tuple(r) for r in names] == [("sales_20260408_20260408094946.csv", "20260408", "20260408094946")]
    assert {file.stamp for file in landed_files(spark, lake.landing_glob("sales"))} == {"20260408094946"}
    assert process_sales(spark, lake, RUN).rows == 500
    assert process_sales(spark, lake, "20260410010000").rows == 500
    assert read_table(spark, lake.raw("sales"), SALES).count() == 1000
