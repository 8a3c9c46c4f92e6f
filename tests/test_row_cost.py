"""What runs once for every landed row: no pattern where plain text functions will do."""

from __future__ import annotations

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from lakebook.functions.casts import lenient
from lakebook.functions.stamps import file_ref, file_stamp, landed_file
from lakebook.plans.jobs import land_snapshot, process_sales
from lakebook.schemas import SALES
from lakebook.sources.landing import read_landing, with_lineage
from lakebook.sources.tables import read_table
from lakebook.streaming.increment import increment

PATHS = {
    "file:/a/sales_20260408_20260408094946.csv": ("sales_20260408_20260408094946.csv", "20260408", "20260408094946"),
    "s3://a/s_1_2.csv/part-0.csv": ("s_1_2.csv", "1", "2"),
    "s3://a/s_1_2.csv/other.csv": ("other.csv", None, None),
    "s3://a/folder/part-0_1.csv": ("part-0_1.csv", "1.csv", None),
    "s3://a/.csv/part-0.csv": ("part-0.csv", None, None),
    "s3://a/s_1_2.csv/x": (None, None, None),
    "s3://a/.csv": (None, None, None),
    "a__.csv": ("a__.csv", "", ""),
    "a/_b_c.csv_d.csv": ("_b_c.csv_d.csv", "b", "c"),
    "a/b_1_2": (None, None, None),
}


def _plan(frame) -> str:
    return frame._jdf.queryExecution().optimizedPlan().toString().lower()


def test_stamps_of_odd_paths(spark):
    frame = spark.createDataFrame([(p,) for p in PATHS], "p string").select("p", F.struct(F.col("p").alias("file_path")).alias("_metadata"))
    name = landed_file()
    rows = frame.select("p", name.alias("n"), file_ref(name).alias("r"), file_stamp(name).alias("s")).collect()
    assert {r.p: (r.n, r.r, r.s) for r in rows} == PATHS


def test_lineage_needs_no_pattern(spark, land):
    """A pattern tried along the path took nine tenths of a scan's time."""
    path = land("users", "20260408094946", "user_id\nu-1\n")
    plan = _plan(with_lineage(read_landing(spark, path), "20260409120000"))
    assert "substring_index" in plan
    assert not any(word in plan for word in ("regexp", "rlike", "split("))


def test_each_step_of_the_lineage_runs_once_a_row(spark, land):
    """Repeated wherever their results were used, the searches took half of a scan's time."""
    path = land("users", "20260408094946", "user_id\nu-1\n")
    rows = with_lineage(read_landing(spark, path), "20260409120000")
    assert _plan(rows).count("substring_index") <= 5
    assert _plan(rows.select("user_id", "ts_file_generation")).count("substring_index") <= 3


def test_lineage_of_odd_files(spark, tmp_path):
    """Parts are cut out by bytes, also of names that Spark encodes or that need several bytes a letter."""
    names = {
        "s_1_2.csv/part-0.csv": ("s_1_2.csv", "1", "2"),
        "s_1_2.csv/other.csv": ("other.csv", None, None),
        "s_1_2.csv/part-1": ("s_1_2.csv", "1", "2"),
        "vendas_é_ção_x.csv/part-0.csv": ("vendas_é_ção_x.csv", "é", "ção"),
        "plain/á_ü_ß.csv": ("á_ü_ß.csv", "ü", "ß"),
        "plain/x_b_c.csv_d.csv": ("x_b_c.csv_d.csv", "b", "c"),
        "plain/a__.csv": ("a__.csv", "", ""),
        "plain/a_b.csv": ("a_b.csv", "b.csv", None),
        "plain/a_b_c": (None, None, None),
        "plain/a b_c d_e%20f.csv": ("a%20b_c%20d_e%2520f.csv", "c%20d", "e%2520f"),
    }
    for name in names:
        file = tmp_path / name
        file.parent.mkdir(exist_ok=True)
        file.write_text(f"of,n\n{name},1\n")
    landed = read_landing(spark, f"{tmp_path}/*/*")
    rows = with_lineage(landed, "20260409120000")
    assert rows.columns == ["of", "n", "filename", "ref", "ts_file_generation", "ts_proc"]
    found = {r.of: (r.filename, r.ref, r.ts_file_generation) for r in rows.collect()}
    assert found == names
    name = landed_file()
    said = landed.select("of", name.alias("n"), file_ref(name).alias("r"), file_stamp(name).alias("s")).collect()
    assert {r.of: (r.n, r.r, r.s) for r in said} == names


def test_plain_whole_numbers_are_cast_before_a_pattern_is_tried(spark):
    values = ["7", "0", "007", "17.0", "999999999", "9999999999", "1.0.0", "7\x00.0", " 7.0", "-4.0", ".0", ""]
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    mine = frame.select("v", lenient(F.col("v"), IntegerType()).alias("n"))
    assert {r.v: r.n for r in mine.collect()} == {
        "7": 7, "0": 0, "007": 7, "17.0": 17, "999999999": 999999999, "9999999999": None, "1.0.0": None,
        "7\x00.0": None, " 7.0": 7, "-4.0": -4, ".0": 0, "": None,
    }
    large = spark.range(1).select(F.col("id").cast("string").alias("v")).select(lenient(F.col("v"), IntegerType()))
    plan = _plan(large)
    assert plan.index("ltrim" if "ltrim" in plan else "trim(leading") < plan.index("rlike")


@pytest.mark.parametrize("streamed", [True, False])
def test_a_day_gets_one_file_though_shuffles_have_few_large_partitions(spark, lake, tmp_path, streamed):
    """Cut over several tasks, a partition of many days made a file for each day and task."""
    day = F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 40).cast("int"))
    sales = spark.range(0, 40_000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("transaction_id"),
        F.lit("u").alias("user_id"),
        F.lit("p").alias("product_id"),
        F.concat(day.cast("string"), F.lit(" 00:00:00")).alias("dat_creation"),
        F.lit("1.00").alias("amount"),
        F.lit("1").alias("quantity"),
        F.lit("PIX").alias("payment_method"),
    )
    land_snapshot(lake, "sales", sales, datetime(2026, 4, 8))
    few = spark.newSession()
    few.conf.set("spark.sql.shuffle.partitions", "2")
    few.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "400KB")
    if streamed:
        increment(few, lake, "sales", "20260409010000", str(tmp_path / "checkpoint"))
        path = lake.raw_increment("sales")
    else:
        process_sales(few, lake, "20260409010000")
        path = lake.raw("sales")
    assert read_table(spark, path, SALES).count() == 40_000
    files = [file.parent for file in Path(path).glob("ref=*/ts_proc=*/*.parquet")]
    assert len(files) == len(set(files)) == 40
