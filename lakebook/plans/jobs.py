"""The daily jobs: land a snapshot, turn it into raw rows, publish the book."""

from __future__ import annotations

from collections import defaultdict
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebook.layout import BOOK_CONTROL, Lake, checked_stamp, day, stamp
from lakebook.operators.conform import CONFORM
from lakebook.operators.control import batch_control_row, book_control_row
from lakebook.plans.book import feature_book
from lakebook.operators.recent import LOOKBACK_DAYS, first_ref
from lakebook.schemas import BATCH_CONTROL, BOOK_CONTROL as BOOK_LEDGER, PRODUCTS, RAW, SALES
from lakebook.sources.jdbc import read_snapshot
from lakebook.sources.landing import read_landing, with_lineage, write_landing
from lakebook.plans.newest import newest_file_run, newest_run
from lakebook.sources.runs import LandedFile, Run, RunIndex, landed_files
from lakebook.sources.tables import Written, append, append_batch, read_run, read_table, set_ledger


def land_snapshot(
    lake: Lake, subject: str, snapshot: DataFrame, logical: datetime, compression: str | None = None
) -> str:
    """Write a full copy of a source table to the landing zone; returns its path.

    The file is named after the run's logical time, so a rerun replaces it. Every landed
    copy stays; ``compression="gzip"`` packs those of large tables.
    """
    path = lake.landing_file(subject, day(logical), stamp(logical))
    write_landing(snapshot, path, compression=compression)
    return path


def land_table(
    spark: SparkSession,
    lake: Lake,
    subject: str,
    logical: datetime,
    url: str,
    *,
    compression: str | None = None,
    **options,
) -> str:
    """Land a table of a relational source; ``options`` as for ``read_snapshot``."""
    return land_snapshot(lake, subject, read_snapshot(spark, url, subject, **options), logical, compression)


def _process(
    spark: SparkSession,
    lake: Lake,
    subject: str,
    path: str,
    ts_proc: str,
    *,
    spread_by: str | None = None,
    multiline: bool = False,
    replace: bool = False,
    reuse: bool = False,
) -> Written:
    files, read_as = landed_files(spark, path), {"multiline": multiline}
    kept = _kept_files(spark, lake, subject, files, read_as) if reuse else None
    if kept is None:
        rows = _landed_rows(spark, subject, path, ts_proc, multiline)
    else:
        run, same = kept
        rows = _rows_again(spark, lake, subject, run, same, ts_proc)
        fresh = [file.path for file in files if file not in same]
        if fresh:
            rows = rows.unionByName(_landed_rows(spark, subject, fresh, ts_proc, multiline))
    written = append_batch(
        rows,
        lake.raw(subject),
        ts_proc=ts_proc,
        spread_by=spread_by,
        replace=ts_proc if replace else None,
        files=files,
        read_as=read_as,
    )
    row = batch_control_row(
        spark, subject, written.ref, written.ts_file_generation, ts_proc, written.rows
    ).where(F.col("qtd_registros") > 0)
    if replace:
        set_ledger(spark, lake.control(subject), BATCH_CONTROL, row, [int(ts_proc)])
    elif written.rows:
        row.write.mode("append").partitionBy("ref").parquet(lake.control(subject))
    return written


def _landed_rows(spark: SparkSession, subject: str, path: str | list[str], ts_proc: str, multiline: bool) -> DataFrame:
    return CONFORM[subject](with_lineage(read_landing(spark, path, multiline=multiline), ts_proc))


def _kept_files(
    spark: SparkSession, lake: Lake, subject: str, files: list[LandedFile], read_as: dict
) -> tuple[Run, set[LandedFile]] | None:
    """The newest run, and the files that it has read and that are still as they were.

    Raw rows know the stamp of their file only, so a stamp counts with all of its files or
    not at all. None if nothing can be taken over.
    """
    run = next(RunIndex(spark, lake.raw(subject)).newest_first(), None)
    if run is None or run.read_as != read_as:
        return None
    then, now = defaultdict(set), defaultdict(set)
    for held, found in ((then, run.files), (now, files)):
        for file in found:
            held[file.stamp].add(file)
    same = {file for stamp, held in now.items() if stamp is not None and then.get(stamp) == held for file in held}
    return (run, same) if same else None


def _rows_again(
    spark: SparkSession, lake: Lake, subject: str, run: Run, same: set[LandedFile], ts_proc: str
) -> DataFrame:
    """The rows that a run has of the given files, under a new run stamp."""
    rows = read_run(spark, lake.raw(subject), RAW[subject], run)
    stamps = {file.stamp for file in same}
    gone = {file.stamp for file in run.files} - stamps - {None}
    stamp = F.col("ts_file_generation")
    rows = rows.where(stamp.isNotNull() & ~stamp.isin(list(gone)) if gone else stamp.isNotNull())
    return rows.withColumn("ts_proc", F.lit(checked_stamp(ts_proc))).select(*RAW[subject].names)


def process_products(
    spark: SparkSession, lake: Lake, path: str, ts_proc: str, **options
) -> Written:
    """Append one landed products file to raw, with its ledger row.

    All rows of a file share one partition, so nothing is shuffled.
    """
    return _process(spark, lake, "products", path, ts_proc, **options)


def process_users(spark: SparkSession, lake: Lake, path: str, ts_proc: str, **options) -> Written:
    """Append one landed users file to raw, with its ledger row."""
    return _process(spark, lake, "users", path, ts_proc, **options)


def process_sales(
    spark: SparkSession, lake: Lake, ts_proc: str, path: str | None = None, **options
) -> Written:
    """Append every landed sales file to raw, with one ledger row for the run.

    Each run holds all files again, as later steps expect of it. Files that the newest run
    has read, and that have since kept their length and time, are not opened: their rows are
    taken from that run, typed and columnar, and only new and changed files are parsed.
    ``reuse=False`` parses all. ``lakebook.streaming.increment`` also writes each file's
    rows only once. Sales of one file spread over many days, so rows are gathered by day
    before they are written.
    """
    options.setdefault("reuse", True)
    return _process(
        spark,
        lake,
        "sales",
        path or lake.landing_glob("sales"),
        ts_proc,
        spread_by="ref",
        **options,
    )


def publish_book(
    spark: SparkSession,
    lake: Lake,
    as_of: date,
    ts_proc: str,
    *,
    replace: bool = False,
    increments: bool = False,
    lookback_days: int | None = LOOKBACK_DAYS,
    **options,
) -> int:
    """Build the book from raw, append it to curated with its ledger row.

    With ``increments`` the sales are those that ``lakebook.streaming.increment`` has
    stored, each file once, and the newest file is the current table: a run that
    picks up an old file late does not bring it back. Without, every run holds all
    files, and the newest run decides.
    """
    checked_stamp(ts_proc)
    if increments:
        sales, lead = read_table(spark, lake.raw_increment("sales"), SALES), "ts_file_generation"
    else:
        sales, lead = newest_run(spark, lake.raw("sales"), SALES, first_ref(as_of, lookback_days)), "ts_proc"
    book = feature_book(
        sales,
        newest_file_run(spark, lake.raw("products"), PRODUCTS),
        as_of,
        ts_proc,
        lookback_days=lookback_days,
        sales_lead=lead,
        **options,
    )
    rows = append(book, lake.curated(), replace=ts_proc if replace else None).get("rows") or 0
    row = book_control_row(spark, day(as_of), ts_proc, rows)
    if replace:
        set_ledger(spark, lake.control(BOOK_CONTROL), BOOK_LEDGER, row, [int(ts_proc)])
    else:
        row.write.mode("append").partitionBy("ref").parquet(lake.control(BOOK_CONTROL))
    return rows
