"""What several operators need: stored tables and their end, row numbers, memory of tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextvars import ContextVar
from functools import wraps

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakebook.session import hadoop_path, shared_folder

#: The white space that separates words: blank, and tab to carriage return.
WHITE = r"\x20\x09-\x0D"
#: Rows of a lookup table (some tens of bytes each) up to which it is broadcast; larger
#: ones are joined by a shuffle.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of an Arrow batch: some MB of text, of which a Python worker holds a few copies.
BATCH_ROWS = 1_000
_BATCHES = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bound the texts that a Python worker holds at once; a setting that stays on the session."""
    if int(spark.conf.get(_BATCHES)) > BATCH_ROWS:
        spark.conf.set(_BATCHES, str(BATCH_ROWS))


def all_columns(frame: DataFrame) -> list[Column]:
    """Every column, whatever signs its name holds."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in frame.columns]


_open: ContextVar[tuple[Scratch, ...]] = ContextVar("open_scratch", default=())


class Scratch:
    """What an operator stores and broadcasts on its way, for as long as it needs it.

    Tables stored and values shared inside ``with Scratch(spark)`` are removed, on disk and
    in the executors' memory, when the block ends, and so are shuffle files that no job
    needs any more. A table ``stored(..., outlive=True)`` belongs to the block around, if
    there is one, or else to the application. Nothing that reads the others may be left to
    be computed after the block.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []
        self.values: list[Broadcast] = []

    def __enter__(self) -> Scratch:
        self._before = _open.set((*_open.get(), self))
        return self

    def __exit__(self, *failed) -> None:
        _open.reset(self._before)
        for value in self.values:
            value.destroy()
        for path in self.paths:
            found, system = hadoop_path(self.spark, path)
            system.delete(found, True)
        # Spark deletes the shuffle files of ended jobs when the driver's JVM collects them.
        self.spark.sparkContext._jvm.System.gc()


def shared_value(spark: SparkSession, value) -> Broadcast:
    """A broadcast that ends with the scratch block around, if there is one."""
    held = spark.sparkContext.broadcast(value)
    if _open.get():
        _open.get()[-1].values.append(held)
    return held


def stored(
    frame: DataFrame, purpose: str, outlive: bool = False, by: str | None = None, compression: str | None = None
) -> DataFrame:
    """The rows, written once to the folder that all executors share and read from there.

    This cuts the lineage: a lost executor costs no more than the stages that follow. With
    ``by`` they lie in a folder for each value of a column, and filters on it open no other.
    """
    spark = frame.sparkSession
    path = shared_folder(spark, purpose)
    around = _open.get()[:-1] if outlive else _open.get()
    if around:
        around[-1].paths.append(path)
    frame.write.parquet(path, partitionBy=by, compression=compression)
    return spark.read.schema(_nullable(frame.schema)).parquet(path)


#: glibc's number of the setting, and the bytes from which memory is mapped on its own.
_MMAP_THRESHOLD, _MAPPED = -3, 8 << 20


def _libc(name: str):
    return getattr(ctypes.CDLL(None), name, None)  # not in every C library


def frugal() -> None:
    """Let large buffers go back to the system as soon as they are free.

    Both Arrow's own pool and the C library would else keep them for later use, and with
    them the highest peak that a worker ever had.
    """
    pa.set_memory_pool(pa.system_memory_pool())
    if set_option := _libc("mallopt"):
        set_option(_MMAP_THRESHOLD, _MAPPED)


def release() -> None:
    """Give memory that is free but still held back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := _libc("malloc_trim"):
        trim(0)


def releasing(run: Callable) -> Callable:
    """A function over the batches of a task that keeps no memory beyond its needs.

    A Python worker serves many tasks; what one of them needed at its peak would else count
    beside the peaks of all that follow.
    """

    @wraps(run)
    def whole(batches: Iterator) -> Iterator:
        frugal()
        yield from run(batches)
        release()

    return whole


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def lookup(frame: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table, marked for broadcast if its counted rows allow it."""
    return F.broadcast(frame) if frame.count() <= limit else frame


def held_out(doc_id: str | Column) -> Column:
    """Documents that no model may learn from: crc32 of the id as text leaves 2 modulo 4."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def numbered(frame: DataFrame, order: list[Column], name: str, partitions: int | None = None) -> DataFrame:
    """All rows numbered from 0 without a gap, in the given order, ties in any order.

    Rows are sorted into ranges and stored with their place in their range; what is
    gathered is one count per range. No task sees more than its range. The stored rows
    outlive a scratch block, since the result reads them.
    """
    spark = frame.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = stored(
        frame.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_lb_at", F.monotonically_increasing_id()),
        "numbered",
        outlive=True,
    )
    in_range = F.shiftright("_lb_at", 33)
    counts = sorted(
        (r["part"], r["n"])
        for r in placed.groupBy(in_range.alias("part")).agg(F.count("*").alias("n")).collect()
    )
    starts, total = [], 0
    for part, count in counts:
        starts.append((part, total))
        total += count
    offsets = spark.createDataFrame(starts, "_lb_part long, _lb_start long")
    return (
        placed.join(F.broadcast(offsets), in_range == F.col("_lb_part"))
        .withColumn(name, F.col("_lb_start") + F.col("_lb_at").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_lb_at", "_lb_part", "_lb_start")
    )
