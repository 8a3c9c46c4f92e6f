"""Landing zone: snapshots as CSV, whose file names carry the batch metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lakebook.functions.stamps import file_ref, folder_of, landed_name, part_after, without_suffix
from lakebook.layout import checked_stamp
from lakebook.session import free_shuffles

# Inner quotes are doubled. Spark's default, a backslash, would shift columns
# in any row whose text holds a quote.
_DIALECT = {"header": "true", "quote": '"', "escape": '"'}
# The writer trims text by default; a snapshot must come back as it was.
_AS_IS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# Of packed parts: landed rows have much in common, which the fastest level finds too.
_FAST = {"zlib.compress.level": "BEST_SPEED"}


def reader_options(multiline: bool = False) -> dict[str, str]:
    """CSV options; ``enforceSchema`` off makes files with other headers fail.

    ``multiline`` allows line breaks inside quotes, at the price that a file can
    no longer be split over tasks.
    """
    return _DIALECT | {"enforceSchema": "false", "multiLine": str(multiline).lower()}


# A file with line breaks in its texts is read by one task, so none may grow without end.
ROWS_PER_FILE = 1_000_000


def write_landing(
    snapshot: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE, compression: str | None = None
) -> None:
    """Write a snapshot as CSV under ``path``, replacing what an earlier run left.

    ``path`` ends in ``subject_ref_stamp.csv`` and becomes a folder with one part
    per task, or several of at most ``rows_per_file`` rows. NULL is an empty field; an
    empty text is read back as NULL, too. With ``compression`` (``gzip``) the parts are
    packed; readers tell by the suffix, and one task reads a part.
    """
    free_shuffles(snapshot.sparkSession)
    text = snapshot.select(
        [
            F.col(f.name) if isinstance(f.dataType, StringType) else F.col(f.name).cast("string")
            for f in snapshot.schema
        ]
    )
    writer = text.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    writer.options(**_DIALECT, **_AS_IS, **_FAST).csv(path, compression=compression)


def read_landing(spark: SparkSession, path: str | list[str], *, multiline: bool = False) -> DataFrame:
    """One landed file, a list, or a glob of them. The header names the columns, all text."""
    return spark.read.options(**reader_options(multiline)).csv(path)


def with_lineage(landed: DataFrame, ts_proc: str) -> DataFrame:
    """Add the file name, the date and stamp it carries, and the run stamp.

    Only works directly on a file scan, where ``_metadata`` is known.

    The columns are what ``landed_file``, ``file_ref`` and ``file_stamp`` say, taken in a
    projection a step, so that each step runs once a row. Until the last ones, the columns
    hold parts of the path.
    """
    path, name = F.col("_metadata.file_path"), F.col("_metadata.file_name")
    filename, ref, stamp = (F.col(column) for column in ("filename", "ref", "ts_file_generation"))
    return (
        landed.withColumns({"filename": folder_of(path, name), "ref": name, "ts_file_generation": name})
        .withColumn("filename", landed_name(filename, stamp))
        .withColumns({"ref": F.substring_index(filename, "_", 1), "ts_file_generation": F.substring_index(filename, "_", 2)})
        .withColumns({"ref": part_after(filename, ref), "ts_file_generation": part_after(filename, stamp)})
        .withColumn("ts_file_generation", without_suffix(stamp))
        .withColumn("ts_proc", F.lit(checked_stamp(ts_proc)))
    )
