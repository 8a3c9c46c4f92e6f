from __future__ import annotations

from datetime import date

import pytest

from lakebook.operators.snapshot import (
    batch_profile,
    latest_batch,
    newest_version,
)
from lakebook.plans.book import current_sales

OLD_RUN, NEW_RUN = "20260401010000", "20260402010000"
OLD_FILE, NEW_FILE = "20260401000000", "20260402000000"
SCHEMA = "ts_proc string, ts_file_generation string, id int"


def batches(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def ids(frame):
    return sorted(r.id for r in frame.collect())


@pytest.fixture
def reprocessed(spark):
    """The old file read again by the newer run, without the new file."""
    return batches(
        spark,
        (OLD_RUN, OLD_FILE, 1),
        (OLD_RUN, NEW_FILE, 2),
        (NEW_RUN, OLD_FILE, 3),
    )


def test_sales_follow_the_run_and_products_the_file(reprocessed):
    assert ids(latest_batch(reprocessed, "ts_proc")) == [3]
    assert ids(latest_batch(reprocessed, "ts_file_generation")) == [2]


def test_only_the_newest_file_of_the_newest_run_survives(spark):
    frame = batches(spark, (NEW_RUN, OLD_FILE, 1), (NEW_RUN, NEW_FILE, 2), (NEW_RUN, NEW_FILE, 3))
    assert ids(latest_batch(frame, "ts_proc")) == [2, 3]


def test_incomplete_keys_are_never_selected(spark):
    frame = batches(spark, (NEW_RUN, None, 1), (None, NEW_FILE, 2), (OLD_RUN, OLD_FILE, 3))
    assert ids(latest_batch(frame, "ts_proc")) == [3]
    assert ids(latest_batch(frame, "ts_file_generation")) == [3]


def test_nothing_to_select(spark):
    for frame in (batches(spark, (None, None, 1)), batches(spark)):
        assert newest_version(frame, "ts_proc").first()[0] is None
        assert ids(latest_batch(frame, "ts_proc")) == []
    

def test_odd_file_stamps_compare_as_text(spark):
    """File names decide their stamps, so these need not have 14 digits."""
    frame = batches(spark, (OLD_RUN, "2026", 1), (OLD_RUN, "20260401070245", 2))
    assert ids(latest_batch(frame, "ts_file_generation")) == [1]


def test_profile_counts_rows_per_batch(reprocessed):
    profile = batch_profile(reprocessed, "ts_proc").collect()
    profile = {r.dedup_key: r.qtd_registros for r in profile}
    assert profile == {OLD_RUN + OLD_FILE: 1, OLD_RUN + NEW_FILE: 1, NEW_RUN + OLD_FILE: 1}


STORED = "ts_proc string, ts_file_generation string, ref string, id int"
LAST_RUN = "20260403010000"


def stored(spark, path, *rows):
    spark.createDataFrame(list(rows), STORED).write.partitionBy("ref", "ts_proc").parquet(str(path))
    return spark.read.schema(STORED).parquet(str(path))


def partition_filters(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return [
        line.split("PartitionFilters")[1].split("PushedFilters")[0]
        for line in plan.splitlines()
        if "PartitionFilters" in line
    ]


@pytest.mark.parametrize(("lead", "expected"), [("ts_proc", [3]), ("ts_file_generation", [2])])
def test_every_scan_is_pruned_to_the_run(spark, tmp_path, lead, expected):
    """Three runs; the last one reads the old file again."""
    rows = stored(
        spark, tmp_path / "raw", (OLD_RUN, OLD_FILE, "20260401", 1),
        (NEW_RUN, NEW_FILE, "20260402", 2), (LAST_RUN, OLD_FILE, "20260401", 3),
    )
    newest = latest_batch(rows, lead)
    assert ids(newest) == expected
    filters = partition_filters(newest)
    run = LAST_RUN if lead == "ts_proc" else NEW_RUN
    assert filters and all("ts_proc" in f and run in f for f in filters)


def test_a_stored_run_without_a_complete_key_is_passed_over(spark, tmp_path):
    rows = stored(
        spark, tmp_path / "raw", (OLD_RUN, OLD_FILE, "20260401", 1),
        (NEW_RUN, None, "20260402", 2), (None, NEW_FILE, "20260402", 3),
    )
    assert ids(latest_batch(rows, "ts_proc")) == [1]
    assert ids(latest_batch(rows, "ts_file_generation")) == [1]


def test_no_stored_run_has_a_complete_key(spark, tmp_path):
    rows = stored(spark, tmp_path / "raw", (NEW_RUN, None, "20260402", 2))
    assert ids(latest_batch(rows, "ts_proc")) == []


def test_the_look_back_comes_before_the_newest_stored_run(spark, tmp_path):
    rows = stored(
        spark, tmp_path / "raw", (OLD_RUN, OLD_FILE, "20260401", 1), (NEW_RUN, NEW_FILE, "20200101", 2)
    )
    assert ids(current_sales(rows, date(2026, 4, 8), 180)) == [1]
    assert ids(current_sales(rows, date(2026, 4, 8), None)) == [2]
