"""Partitioned parquet tables of the raw, curated and control zones."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakebook.schemas import PARTITIONS
from lakebook.session import free_shuffles, hadoop_path
from lakebook.sources.runs import LandedFile, Run, RunIndex, attempt_of, run_files


DEFAULT_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match a pattern of names, without a look at what is in them."""
    path, system = hadoop_path(spark, pattern)
    return [str(status.getPath()) for status in system.globStatus(path) or [] if status.isDirectory()]


def in_look_back(ref: str | None, first_ref: int) -> bool:
    """Whether a folder's ``ref`` is a number from ``first_ref`` on."""
    return ref is not None and ref.isascii() and ref.isdecimal() and int(ref) >= first_ref


def read_table(
    spark: SparkSession, path: str, schema: StructType, first_ref: int | None = None
) -> DataFrame:
    """Read a table with its declared schema; no file is opened to infer one.

    With ``first_ref`` only folders whose ``ref`` is a number from there on are listed
    at all: the folder names of the first level decide, so the driver holds no file of
    older days. Such a read does not consult a streaming sink's log; leave ``first_ref``
    out for tables that a stream writes.

    Of a run that is just being replaced, the attempt that its entry names is read.
    """
    if first_ref is None:
        return _published(spark, path, spark.read.schema(schema).parquet(path))
    names = (folder.rpartition("ref=")[2] for folder in _folders(spark, f"{path}/ref=*"))
    return _read_folders(spark, path, schema, [f"ref={n}" for n in names if in_look_back(n, first_ref)])


def read_run(spark: SparkSession, path: str, schema: StructType, run: Run, first_ref: int | None = None) -> DataFrame:
    """The rows of one run, in days from ``first_ref`` on: no other folder is listed."""
    refs = [ref for ref in run.refs if first_ref is None or in_look_back(ref, first_ref)]
    folders = [f"ref={name}/ts_proc={run.ts_proc}" for name in _folder_values(refs)]
    return _read_folders(spark, path, schema, folders)


def _read_folders(spark: SparkSession, path: str, schema: StructType, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", path)
    return _published(spark, path, reader.parquet(*[f"{path}/{folder}" for folder in folders]))


def _published(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Without files of runs that are being replaced, unless their entry names them."""
    index = RunIndex(spark, path)
    for ts_proc in index.replacing():
        run = index.get(ts_proc)
        name, named = F.col("_metadata.file_name"), F.lit(False)
        for attempt in run.attempts if run else ():
            named = named | F.contains(name, F.lit(attempt))
        rows = rows.where((F.coalesce(F.col("ts_proc"), F.lit("")) != ts_proc) | named)
    return rows


@dataclass(frozen=True)
class Written:
    """What one write put down: its rows, and one batch stamp among them."""

    rows: int
    ref: str | None = None
    ts_file_generation: str | None = None


# A shuffle's partition that outgrows its advisory size is cut over several tasks, each of
# which opens a file for all values of the partition. With many partitions, which adaptive
# execution merges, only a value that is large by itself gets several files.
SPREAD_PARTITIONS = 1000


def spread(rows: DataFrame, by: str) -> DataFrame:
    """Gather rows of one partition value in few tasks, however few partitions shuffles have."""
    partitions = max(SPREAD_PARTITIONS, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.hint("rebalance", partitions, by)


def append(
    rows: DataFrame,
    path: str,
    partitions: Sequence[str] = PARTITIONS,
    *,
    ts_proc: str | None = None,
    spread_by: str | None = None,
    replace: str | None = None,
    observe: Sequence[Column] = (),
    files: Sequence[LandedFile] = (),
    read_as: dict | None = None,
) -> dict:
    """Append ``rows`` to a partitioned table and report on them in the same pass.

    ``spread_by`` gathers rows of one partition value into few files, where each
    task would otherwise open a file for every value it meets. It rebalances
    rather than hash-partitions: adaptive execution splits a value that holds a
    large share of the rows over several tasks.

    The observed metrics sit in the stage that writes, past any shuffle, so a
    task that is run again after a lost executor is not counted twice.

    ``ts_proc`` names the run stamp of all ``rows``; the run then gets an entry in the
    table's run index, with the landed ``files`` it was made of and how they were read.

    ``replace`` names it too. Afterwards the table holds, of that run, these rows only. The
    new files are written beside the old ones; readers of this package see the old ones
    until the run's entry is exchanged, and the new ones from then on; then the old ones
    are removed. A repeated call leaves the same, also after one that broke off.
    """
    ts_proc = replace or ts_proc
    if spread_by is not None:
        rows = spread(rows, spread_by)
    seen = Observation()
    own = [] if ts_proc is None else [F.collect_set(F.coalesce("ref", F.lit(""))).alias("_refs"), *_newest(rows)]
    writer = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *own, *observe).write.mode("append")
    spark = rows.sparkSession
    free_shuffles(spark)
    if ts_proc is None:
        writer.partitionBy(*partitions).parquet(path)
        return seen.get
    index = RunIndex(spark, path)
    before = index.get(ts_proc)
    held = []
    if replace is not None:
        held = run_files(spark, path, replace)
        if before is None:
            before = Run(replace, attempts=tuple({attempt_of(f.getPath().getName()) or "-" for f in held}))
        index.put(before)
        index.begin(replace)
    writer.partitionBy(*partitions).parquet(path)
    found = seen.get
    refs = [ref or None for ref in found.get("_refs") or []]
    old = {attempt_of(f.getPath().getName()) for f in held} if before is None or replace else set(before.attempts)
    now = {attempt_of(f.getPath().getName()) for f in run_files(spark, path, ts_proc, [f"ref={n}" for n in _folder_values(refs[:1])])}
    run = Run(ts_proc, found.get("rows") or 0, found.get("_newest"), tuple(refs), tuple(sorted(now - old - {None})), tuple(files), read_as or {})
    if replace is None and before is not None:
        run = _joined(before, run)
    index.put(run)
    if replace is not None:
        for status in held:
            remove(spark, status.getPath().toString())
        index.end(replace)
        _drop_empty(spark, {status.getPath().getParent().toString() for status in held})
    return found


def _newest(rows: DataFrame) -> list[Column]:
    return [F.max("ts_file_generation").alias("_newest")] if "ts_file_generation" in rows.columns else []


def _joined(a: Run, b: Run) -> Run:
    """One entry for a run that appended twice; it stands for no set of landed files."""
    return Run(
        b.ts_proc, a.rows + b.rows, max(filter(None, (a.newest, b.newest)), default=None),
        tuple(dict.fromkeys([*a.refs, *b.refs])), tuple(dict.fromkeys([*a.attempts, *b.attempts])),
    )


def _drop_empty(spark: SparkSession, folders: set[str]) -> None:
    """Remove run folders that hold no data file any more."""
    for folder in folders:
        path, system = hadoop_path(spark, folder)
        if system.exists(path) and not any(not s.getPath().getName().startswith((".", "_")) for s in system.listStatus(path)):
            system.delete(path, True)
            day = path.getParent()
            if system.exists(day) and not system.listStatus(day):
                system.delete(day, True)


def _folder_values(refs: Sequence[str | None] | None) -> list[str]:
    """Partition values as folder names; what a path cannot hold is percent-encoded."""
    return [
        "".join(f"%{ord(c):02X}" if c in _ESCAPED or ord(c) < 32 else c for c in ref) if ref else DEFAULT_FOLDER
        for ref in refs or []
    ]


_ESCAPED = set("\"#%'*/:=?\\\x7f{[]^")


def remove(spark: SparkSession, path: str) -> None:
    found, system = hadoop_path(spark, path)
    system.delete(found, True)


def set_ledger(spark: SparkSession, path: str, schema: StructType, rows: DataFrame, runs: Sequence[int]) -> None:
    """Make ``rows`` the ledger's only rows of the given runs.

    A ledger has a row a run. The rows of these runs, and of the days that get one, are
    gathered, and these days' folders rewritten; rows of other days stay where they are.
    """
    names = rows.columns
    new = [tuple(r) for r in rows.collect()]
    at, run_at = names.index("ref"), names.index("ts_proc")
    path_found, system = hadoop_path(spark, path)
    held, gone = [], set()
    if system.exists(path_found):
        ledger = read_table(spark, path, schema).select(*names)
        gone = {r[0] for r in ledger.where(F.col("ts_proc").isin(list(runs))).select("ref").collect()}
        days = [F.col("ref").eqNullSafe(F.lit(day)) for day in gone | {r[at] for r in new}]
        held = ledger.where(reduce(or_, days)).collect() if days else []
    left = [tuple(r) for r in held if r[run_at] not in runs] + new
    kinds = StructType([rows.schema[name] for name in names])
    if left:
        spark.createDataFrame(left, kinds).coalesce(1).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("ref").parquet(path)
    for ref in gone - {r[at] for r in left}:
        remove(spark, f"{path}/ref={_folder_values([None if ref is None else str(ref)])[0]}")


def append_batch(rows: DataFrame, path: str, **options) -> Written:
    """Append a raw batch; report its size and its newest file stamp with a ``ref``."""
    newest = F.max(F.struct("ts_file_generation", "ref")).alias("newest")
    seen = append(rows, path, observe=[newest], **options)
    if not seen.get("rows"):
        return Written(0)
    return Written(seen["rows"], seen["newest"]["ref"], seen["newest"]["ts_file_generation"])
