"""Batches of a raw table: which there are, and the rows of the newest one.

A batch is the rows that share ``ts_proc`` and ``ts_file_generation``. Snapshots
are full copies of their source, so the newest batch is the current table.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from lakebook.functions.stamps import version_key


def with_version_key(rows: DataFrame, lead: str) -> DataFrame:
    return rows.select(version_key(lead).alias("dedup_key"), "*")


def batch_profile(rows: DataFrame, lead: str) -> DataFrame:
    """Rows per batch."""
    return (
        with_version_key(rows, lead)
        .groupBy("dedup_key")
        .agg(F.count(F.lit(1)).alias("qtd_registros"))
    )


def newest_version(rows: DataFrame, lead: str) -> DataFrame:
    """One row: the greatest batch key, NULL if there is none."""
    return rows.agg(F.max(version_key(lead)).alias("max_dedup_key"))


def reads_files(rows: DataFrame) -> bool:
    """Whether ``rows`` come straight from files, whose metadata Spark then offers."""
    try:
        return "ts_proc" in rows.select("*", "_metadata.file_path").columns
    except AnalysisException:
        return False


def _newest_stored(keyed: DataFrame, lead: str) -> Row | None:
    """The newest complete key and its run stamp, read from as few runs as will do."""
    newest = F.max(F.struct("dedup_key", "ts_proc")).alias("newest")
    complete = keyed.where(F.col("dedup_key").isNotNull())
    if lead != "ts_proc":  # any run can hold the newest file
        return complete.agg(newest).first()["newest"]
    run = keyed.agg(F.max("ts_proc")).first()[0]  # of folder names: no column is read
    while run is not None:  # mostly the first one has it
        found = complete.where(F.col("ts_proc") == run).agg(newest).first()["newest"]
        if found is not None:
            return found
        run = keyed.where(F.col("ts_proc") < run).agg(F.max("ts_proc")).first()[0]
    return None


def latest_batch(rows: DataFrame, lead: str) -> DataFrame:
    """Rows of the newest batch, with ``lead`` as the more significant stamp.

    In rows read from files the newest key is looked up when this is called: by tasks,
    over the one narrow column that the folder names lack, in the newest run alone if the
    run stamp leads, in all runs if the file stamp does. The result then filters on the
    run's folder, so files of other runs are never opened for it, and nothing is shuffled
    or joined. Give it the newest run only (``lakebook.plans.newest``) to spare the others
    even their listing.

    Other rows get the newest key as a scalar subquery when they are read.

    Run stamps must have one width, which the writers of this package enforce, so that
    a key stands for one pair of stamps. Rows without a complete key are never selected.
    """
    keyed = with_version_key(rows, lead)
    if reads_files(rows):
        newest = _newest_stored(keyed, lead)
        if newest is None:
            return keyed.where(F.lit(False))
        return keyed.where((F.col("ts_proc") == newest["ts_proc"]) & (F.col("dedup_key") == newest["dedup_key"]))
    found = (
        keyed.where(F.col("dedup_key").isNotNull())
        .agg(F.max(F.struct("dedup_key", "ts_proc")))
        .scalar()
    )
    return keyed.where(
        (F.col("ts_proc") == found.getField("ts_proc"))
        & (F.col("dedup_key") == found.getField("dedup_key"))
    )
