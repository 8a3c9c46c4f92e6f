"""Landing to raw with each landed file read once."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakebook.layout import Lake, checked_stamp
from lakebook.operators.conform import CONFORM
from lakebook.operators.control import batch_control_row
from lakebook.schemas import BATCH_CONTROL, PARTITIONS, RAW
from lakebook.session import free_shuffles, hadoop_path
from lakebook.sources.landing import read_landing, reader_options, with_lineage
from lakebook.sources.tables import read_table, set_ledger, spread


# Spark's file stream passes over files a week older than the newest one, without a
# word. A hundred years let a copy or a backfill keep its times.
MAX_FILE_AGE = "36500d"


def landed_stream(spark: SparkSession, path: str, *, multiline: bool = False) -> DataFrame:
    """Landed files as a stream. The header of what is there names the columns.

    No file is too old. The price is that the stream's log and the driver's memory keep
    the name of every file ever read, some 200 bytes each.
    """
    header = read_landing(spark, path, multiline=multiline).schema
    options = reader_options(multiline) | {"maxFileAge": MAX_FILE_AGE}
    return spark.readStream.schema(header).options(**options).csv(path)


@dataclass(frozen=True)
class Counted:
    """Rows that a run has stored, and the newest stamp among them with its latest ``ref``."""

    rows: int = 0
    ts_file_generation: str | None = None
    ref: str | None = None

    def __add__(self, other: Counted) -> Counted:
        def newest(c: Counted) -> tuple:  # as a struct orders it: missing values first
            return tuple((v is not None, v or "") for v in (c.ts_file_generation, c.ref))

        top = max((c for c in (self, other) if c.rows), key=newest, default=self)
        return Counted(self.rows + other.rows, top.ts_file_generation, top.ref)


def _metrics() -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), F.max(F.struct("ts_file_generation", "ref")).alias("newest")]


def _counted(found) -> Counted:
    newest = found["newest"]
    return Counted(found["rows"], newest["ts_file_generation"], newest["ref"]) if found["rows"] else Counted()


def _observed(query: StreamingQuery, name: str, kept: int) -> Counted | None:
    """What the batches of a finished query have stored; None if it has forgotten some."""
    progress = query.recentProgress
    if len(progress) >= kept:
        return None
    total = Counted()
    for batch in progress:
        found = batch["observedMetrics"].get(name)
        total = total if found is None else total + _counted(found)
    return total


def _owed(spark: SparkSession, checkpoint: str) -> list[str]:
    """Stamps of runs that began and whose ledger row is not known to be written."""
    path, system = hadoop_path(spark, f"{checkpoint}/owed")
    return sorted(s.getPath().getName() for s in system.listStatus(path)) if system.exists(path) else []


def _note(spark: SparkSession, checkpoint: str, ts_proc: str) -> None:
    path, system = hadoop_path(spark, f"{checkpoint}/owed/{ts_proc}")
    system.mkdirs(path)


def _settle(spark: SparkSession, checkpoint: str, ts_proc: str) -> None:
    path, system = hadoop_path(spark, f"{checkpoint}/owed/{ts_proc}")
    system.delete(path, True)


def _stored(spark: SparkSession, lake: Lake, subject: str, ts_proc: str) -> DataFrame:
    """Rows of one run; a filter on its folder name, so no other run's file is opened."""
    return read_table(spark, lake.raw_increment(subject), RAW[subject]).where(F.col("ts_proc") == ts_proc)


def update_ledger(spark: SparkSession, lake: Lake, subject: str, ts_proc: str, counted: Counted | None) -> None:
    """Write a run's ledger row.

    ``counted`` is what this attempt stored; rows that earlier attempts of the same run
    stored are in the ledger already. None: it is not known, and the run's rows are counted
    where they stand.
    """
    path = lake.control(f"{subject}_increment")
    if counted is None:
        counted = _counted(_stored(spark, lake, subject, ts_proc).agg(*_metrics()).first())
    elif not counted.rows:
        return
    else:
        there, system = hadoop_path(spark, path)
        if system.exists(there):
            for row in read_table(spark, path, BATCH_CONTROL).where(F.col("ts_proc") == int(ts_proc)).collect():
                counted = counted + Counted(row["qtd_registros"], row["ts_file_generation"], row["ref"])
    if counted.rows:
        row = batch_control_row(spark, subject, counted.ref, counted.ts_file_generation, ts_proc, counted.rows)
        set_ledger(spark, path, BATCH_CONTROL, row, [int(ts_proc)])


def increment(
    spark: SparkSession,
    lake: Lake,
    subject: str,
    ts_proc: str,
    checkpoint: str,
    *,
    multiline: bool = False,
) -> DataFrame:
    """Append the files landed since the last run to raw, then stop.

    The checkpoint remembers which files were read, and the sink's log which
    output files belong to finished batches: a run that is killed and repeated
    neither loses nor doubles a row. The sink must be the table's only writer,
    which is why increments have their own raw table. Run it when a landing job
    has finished, not beside one.

    The ledger has one row for every run that stored any. Its count is observed in the
    batches as they are written, so nothing is read back. A note beside the checkpoint
    stands from before the stream starts until the row is written; a run that finds the
    note of another, or its own, counts that run's rows where they stand.

    Returns the rows of this run.
    """
    rows = CONFORM[subject](
        with_lineage(landed_stream(spark, lake.landing_glob(subject), multiline=multiline), ts_proc)
    )
    if subject == "sales":
        # As in the batch job: stateless streams run adaptively too.
        rows = spread(rows, "ref")
    checked_stamp(ts_proc)
    free_shuffles(spark)
    owed = _owed(spark, checkpoint)
    _note(spark, checkpoint, ts_proc)
    name = f"increment-{uuid.uuid4().hex}"
    query = (
        rows.observe(name, *_metrics())
        .writeStream.format("parquet")
        .partitionBy(*PARTITIONS)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(lake.raw_increment(subject))
    )
    query.awaitTermination()
    observed = _observed(query, name, int(spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")))

    for run in owed:
        if run != ts_proc:
            update_ledger(spark, lake, subject, run, None)
            _settle(spark, checkpoint, run)
    update_ledger(spark, lake, subject, ts_proc, None if ts_proc in owed else observed)
    _settle(spark, checkpoint, ts_proc)
    return _stored(spark, lake, subject, ts_proc)
