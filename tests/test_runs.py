"""The run index: what is listed and opened, files taken over, and switching of attempts."""

from __future__ import annotations

import os
import shutil
from collections import Counter
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import DataFrame

from lakebook.operators.snapshot import latest_batch
from lakebook.plans.book import current_products, current_sales
from lakebook.plans.jobs import land_snapshot, process_products, process_sales, publish_book
from lakebook.plans.newest import newest_file_run, newest_run
from lakebook.schemas import BATCH_CONTROL, PRODUCTS, SALES
from lakebook.sources import tables
from lakebook.sources.runs import Run, RunIndex, attempt_of, landed_files
from lakebook.sources.tables import append_batch, read_table
from lakebook.streaming.increment import increment

RUNS = ("20260402010000", "20260403010000", "20260404010000")
HEADER = "transaction_id,user_id,product_id,dat_creation,amount,quantity,payment_method\n"
DAYS = ("2026-03-01", "2026-04-01", "2026-04-02")


def sales_text(*ids, days=DAYS):
    return HEADER + "".join(
        f"t-{i},u-{i % 2},p-1,{days[i % len(days)]} 10:00:00,{i}.50,{i},PIX\n" for i in ids
    )


def rows_of(frame):
    return Counter(tuple(r) for r in frame.select(*SALES.names).collect())


def folders(frame):
    return sorted({f.split("ref=")[1].rsplit("/", 1)[0] for f in frame.inputFiles()})


@pytest.fixture
def three_runs(spark, lake, land):
    for i, run in enumerate(RUNS):
        land("sales", f"2026040{i + 1}000000", sales_text(*range(3 * i + 3)))
        process_sales(spark, lake, run)
    return lake


# Newest run ----------------------------------------------------------------------


def test_only_the_newest_run_is_listed(spark, three_runs):
    rows = newest_run(spark, three_runs.raw("sales"), SALES)
    assert folders(rows) == [f"{d.replace('-', '')}/ts_proc={RUNS[2]}" for d in DAYS]
    inside = newest_run(spark, three_runs.raw("sales"), SALES, 20260401)
    assert folders(inside) == [f"{d.replace('-', '')}/ts_proc={RUNS[2]}" for d in DAYS[1:]]
    whole = read_table(spark, three_runs.raw("sales"), SALES)
    assert rows_of(latest_batch(rows, "ts_proc")) == rows_of(latest_batch(whole, "ts_proc"))


@pytest.mark.parametrize("days", [None, 5, 180])
def test_the_newest_run_holds_what_the_whole_table_selects(spark, three_runs, land, days):
    """The newest run lies before the look-back; one before it has no file stamp."""
    land("sales", "20260409000000", sales_text(1, 2, days=["2020-01-01"]))
    process_sales(spark, three_runs, "20260409010000", three_runs.landing_glob("sales").replace("*", "*20260409000000"))
    odd = Path(three_runs.landing("sales"), "odd.csv")
    odd.write_text(sales_text(1, 2))
    process_sales(spark, three_runs, "20260408010000", str(odd))
    first = None if days is None else 20260403 - days
    as_of = date(2026, 4, 3)
    rows = newest_run(spark, three_runs.raw("sales"), SALES, first)
    whole = read_table(spark, three_runs.raw("sales"), SALES)
    assert rows_of(current_sales(rows, as_of, days)) == rows_of(current_sales(whole, as_of, days))


def test_no_file_names_are_gathered(spark, three_runs, land, monkeypatch):
    path = land("products", "20260408094946", "proudct_id,product_des,product_category\np-1,chess,Jogos\n")
    process_products(spark, three_runs, path, RUNS[0])

    def refuse(self):
        raise AssertionError("names of all files")

    with monkeypatch.context() as patch:
        patch.setattr(DataFrame, "inputFiles", refuse)
        patch.setattr(type(spark.range(1)), "inputFiles", refuse)
        assert publish_book(spark, three_runs, date(2026, 4, 8), RUNS[2]) == 2
        whole = read_table(spark, three_runs.raw("sales"), SALES)
        assert {r.ts_proc for r in latest_batch(whole, "ts_proc").collect()} == {RUNS[2]}


def test_the_newest_file_decides_for_products(spark, lake, land):
    text = "proudct_id,product_des,product_category\n"
    old = land("products", "20260401000000", text + "p-1,old,Jogos\n")
    new = land("products", "20260402000000", text + "p-1,new,Jogos\n")
    for run, path in zip(RUNS, (old, new, old), strict=True):
        process_products(spark, lake, path, run)
    rows = newest_file_run(spark, lake.raw("products"), PRODUCTS)
    assert folders(rows) == [f"20260402/ts_proc={RUNS[1]}"]
    assert [r.product_des for r in current_products(rows).collect()] == ["new"]


def test_tables_without_an_index_are_read_whole(spark, three_runs):
    shutil.rmtree(f"{three_runs.raw('sales')}/_runs")
    assert len(folders(newest_run(spark, three_runs.raw("sales"), SALES))) == 9
    newest = latest_batch(newest_run(spark, three_runs.raw("sales"), SALES), "ts_proc")
    assert {(r.ts_proc, r.ts_file_generation) for r in newest.collect()} == {(RUNS[2], "20260403000000")}
    assert rows_of(read_table(spark, three_runs.raw("sales"), SALES)).total() == 3 + 9 + 18


def test_an_empty_index_and_an_empty_run(spark, lake, land):
    assert RunIndex(spark, lake.raw("sales")).stamps() == []
    land("sales", "20260401000000", HEADER)
    process_sales(spark, lake, RUNS[0])
    run = RunIndex(spark, lake.raw("sales")).get(RUNS[0])
    assert (run.rows, run.newest, run.refs, run.attempts) == (0, None, (), ())
    assert newest_run(spark, lake.raw("sales"), SALES).count() == 0


def test_entries(spark, three_runs):
    index = RunIndex(spark, three_runs.raw("sales"))
    assert index.stamps() == sorted(RUNS, reverse=True)
    run = index.get(RUNS[1])
    assert (run.rows, run.newest, len(run.files), len(run.attempts)) == (9, "20260402000000", 2, 1)
    assert sorted(run.refs) == [d.replace("-", "") for d in DAYS]
    assert Run.from_json(run.to_json()) == run
    assert [r.ts_proc for r in index.newest_first()] == index.stamps()
    assert index.newest_file().ts_proc == RUNS[2]
    names = {p.name for p in Path(three_runs.raw("sales")).glob(f"ref=*/ts_proc={RUNS[1]}/part-*")}
    assert {attempt_of(name) for name in names} == set(run.attempts)


def test_a_run_that_appends_twice_has_both_attempts(spark, three_runs):
    process_sales(spark, three_runs, RUNS[2])
    run = RunIndex(spark, three_runs.raw("sales")).get(RUNS[2])
    assert run.rows == 36 and len(run.attempts) == 2 and run.files == ()
    assert newest_run(spark, three_runs.raw("sales"), SALES).count() == 36


# Files taken over ------------------------------------------------------------------


def spoil(path):
    """Other bytes under the same name, length and time: only opening the file shows it."""
    before = os.stat(path)
    Path(path).write_bytes(b"x" * before.st_size)
    os.utime(path, ns=(before.st_atime_ns, before.st_mtime_ns))
    crc = Path(path).with_name(f".{Path(path).name}.crc")
    crc.unlink(missing_ok=True)


def test_an_unchanged_file_is_not_opened_again(spark, lake, land):
    first = land("sales", "20260401000000", sales_text(*range(6)))
    process_sales(spark, lake, RUNS[0])
    spoil(first)
    written = process_sales(spark, lake, RUNS[1])
    assert (written.rows, written.ts_file_generation) == (6, "20260401000000")
    land("sales", "20260402000000", sales_text(*range(9)))
    assert process_sales(spark, lake, RUNS[2]).rows == 15
    rows = read_table(spark, lake.raw("sales"), SALES)
    assert Counter(r.ts_proc for r in rows.collect()) == {RUNS[0]: 6, RUNS[1]: 6, RUNS[2]: 15}
    ledger = read_table(spark, lake.control("sales"), BATCH_CONTROL).collect()
    assert sorted(r.qtd_registros for r in ledger) == [6, 6, 15]


def test_new_changed_and_removed_files_give_what_parsing_gives(spark, lake, land):
    kept, changed, gone = (land("sales", f"2026040{i}000000", sales_text(*range(i * 3))) for i in (1, 2, 3))
    twin = land("sales", "20260404000000", sales_text(1), ref="20260101")
    land("sales", "20260404000000", sales_text(2), ref="20260102")
    odd = Path(lake.landing("sales"), "odd.csv")
    odd.write_text(sales_text(7, 8))
    process_sales(spark, lake, RUNS[0])
    Path(changed).write_text(sales_text(5) + "t-9,u-1,p-1,not a date,1,1,\n")
    Path(gone).unlink()
    Path(twin).write_text(sales_text(1, 4))
    land("sales", "20260405000000", sales_text(3))
    process_sales(spark, lake, RUNS[1])
    again = process_sales(spark, lake, RUNS[2], reuse=False)
    rows = read_table(spark, lake.raw("sales"), SALES)
    taken, parsed = (rows_of(rows.where(f"ts_proc = '{run}'").drop("ts_proc").selectExpr("'' as ts_proc", "*")) for run in RUNS[1:])
    assert taken == parsed and again.rows == parsed.total()


def test_files_parsed_in_another_way_are_parsed_again(spark, lake, land):
    text = HEADER + 't-1,u-1,"p\n1",2026-04-01 10:00:00,1,1,PIX\n'
    land("sales", "20260401000000", text)
    assert process_sales(spark, lake, RUNS[0]).rows == 2
    assert process_sales(spark, lake, RUNS[1], multiline=True).rows == 1
    assert process_sales(spark, lake, RUNS[2], multiline=True).rows == 1


def test_landed_folders_are_told_by_their_parts(spark, lake):
    source = spark.createDataFrame([(1, "chess")], "transaction_id int, user_id string").coalesce(1)
    land_snapshot(lake, "sales", source, datetime(2026, 4, 8, 9, 49, 46))
    found = landed_files(spark, lake.landing_glob("sales"))
    assert len(found) == 1 and found[0].stamp == "20260408094946" and found[0].path.endswith(".csv")
    assert landed_files(spark, lake.landing_glob("users")) == []


# Increments ------------------------------------------------------------------------


def test_a_run_reads_no_file_of_other_runs(spark, lake, land, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    land("sales", "20260401000000", sales_text(*range(3)))
    increment(spark, lake, "sales", RUNS[0], checkpoint)
    for file in Path(lake.raw_increment("sales")).glob("ref=*/ts_proc=*/*.parquet"):
        spoil(file)
    land("sales", "20260402000000", sales_text(*range(6)))
    assert increment(spark, lake, "sales", RUNS[1], checkpoint).count() == 6
    ledger = read_table(spark, lake.control("sales_increment"), BATCH_CONTROL).collect()
    assert sorted((r.ts_proc, r.qtd_registros) for r in ledger) == [(int(RUNS[0]), 3), (int(RUNS[1]), 6)]
    assert list(Path(checkpoint, "owed").iterdir()) == []


def test_a_run_that_stored_and_broke_off_is_counted_where_it_stands(spark, lake, land, tmp_path, monkeypatch):
    checkpoint = str(tmp_path / "checkpoint")
    land("sales", "20260401000000", sales_text(*range(3)))

    def fail(*_):
        raise OSError("no ledger")

    with monkeypatch.context() as patch:
        patch.setattr("lakebook.streaming.increment.update_ledger", fail)
        with pytest.raises(OSError, match="no ledger"):
            increment(spark, lake, "sales", RUNS[0], checkpoint)
    land("sales", "20260402000000", sales_text(*range(6)))
    increment(spark, lake, "sales", RUNS[0], checkpoint)
    ledger = read_table(spark, lake.control("sales_increment"), BATCH_CONTROL).collect()
    assert [(r.ref, r.ts_file_generation, r.ts_proc, r.qtd_registros) for r in ledger] == [
        ("20260402", "20260402000000", int(RUNS[0]), 9)
    ]


# Replacing ---------------------------------------------------------------------------


def test_readers_see_one_attempt_at_every_step(spark, three_runs, land, monkeypatch):
    """Reads before and after each change of the index, and before each removal."""
    table = three_runs.raw("sales")
    others = rows_of(read_table(spark, table, SALES).where(f"ts_proc <> '{RUNS[2]}'"))
    old = rows_of(read_table(spark, table, SALES).where(f"ts_proc = '{RUNS[2]}'"))
    seen = []

    def look():
        rows = read_table(spark, table, SALES)
        assert rows_of(rows.where(f"ts_proc <> '{RUNS[2]}'")) == others
        part = rows_of(rows.where(f"ts_proc = '{RUNS[2]}'"))
        assert rows_of(newest_run(spark, table, SALES)) == part
        seen.append(part)

    def watched(function):
        def call(*args, **options):
            look()
            result = function(*args, **options)
            look()
            return result

        return call

    for owner, name in ((RunIndex, "put"), (RunIndex, "begin"), (RunIndex, "end"), (tables, "remove")):
        monkeypatch.setattr(owner, name, watched(getattr(owner, name)))
    land("sales", "20260409000000", sales_text(1, 2, days=["2026-04-01"]))
    path = three_runs.landing_glob("sales").replace("*", "*20260409000000")
    process_sales(spark, three_runs, RUNS[2], path, replace=True)
    monkeypatch.undo()
    new = rows_of(read_table(spark, table, SALES).where(f"ts_proc = '{RUNS[2]}'"))
    assert new.total() == 2 and old.total() == 18
    assert [part for part, following in zip(seen, seen[1:], strict=False) if part != following] == [old]
    assert all(part in (old, new) for part in seen) and len(seen) > 8
    assert rows_of(spark.read.schema(SALES).parquet(table)) == others + new


def test_a_replacement_that_broke_off_shows_the_old_attempt_until_it_is_repeated(spark, three_runs, monkeypatch):
    table = three_runs.raw("sales")
    old = rows_of(read_table(spark, table, SALES))

    def fail(*_):
        raise OSError("gone")

    put = RunIndex.put
    with monkeypatch.context() as patch:
        patch.setattr(RunIndex, "put", lambda self, run: put(self, run) if run.rows == 18 and not seen else fail())
        seen = []
        patch.setattr(RunIndex, "begin", lambda self, stamp, begin=RunIndex.begin: (begin(self, stamp), seen.append(1)))
        with pytest.raises(OSError, match="gone"):
            process_sales(spark, three_runs, RUNS[2], replace=True, reuse=False)
    assert rows_of(spark.read.schema(SALES).parquet(table)).total() == old.total() + 18
    assert rows_of(read_table(spark, table, SALES)) == old
    process_sales(spark, three_runs, RUNS[2], replace=True)
    assert rows_of(read_table(spark, table, SALES)) == old == rows_of(spark.read.schema(SALES).parquet(table))


def test_a_run_written_without_an_entry_can_be_replaced(spark, three_runs):
    shutil.rmtree(f"{three_runs.raw('sales')}/_runs")
    process_sales(spark, three_runs, RUNS[2], replace=True)
    rows = spark.read.schema(SALES).parquet(three_runs.raw("sales"))
    assert Counter(r.ts_proc for r in rows.collect()) == dict(zip(RUNS, (3, 9, 18), strict=True))


def test_rows_without_a_stamp_get_no_entry(spark, tmp_path):
    rows = spark.createDataFrame([("20260401", RUNS[0], "f", 1)], "ref string, ts_proc string, ts_file_generation string, x int")
    append_batch(rows, str(tmp_path / "t"))
    assert not (tmp_path / "t" / "_runs").exists()
