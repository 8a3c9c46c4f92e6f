"""The newest batch of a stored table, found by its run index.

Listing names of runs finds the newest one; only its folders are listed and opened, and of
these only days inside the look-back. Tables without an index are read as a whole, and
``latest_batch`` then finds the newest batch among all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakebook.sources.runs import RunIndex
from lakebook.sources.tables import in_look_back, read_run, read_table


def newest_run(spark: SparkSession, path: str, schema: StructType, first_ref: int | None = None) -> DataFrame:
    """Rows of the newest run that holds a complete batch key on a day from ``first_ref`` on.

    Holds all rows of the batch that ``latest_batch`` with a leading ``ts_proc`` selects.
    """
    index = RunIndex(spark, path)
    if not index.stamps():
        return read_table(spark, path, schema, first_ref)
    for run in index.newest_first():
        if run.newest is None or not (first_ref is None or any(in_look_back(r, first_ref) for r in run.refs)):
            continue
        rows = read_run(spark, path, schema, run, first_ref)
        if not rows.where(F.col("ts_file_generation").isNotNull()).isEmpty():
            return rows
    return spark.createDataFrame([], schema)


def newest_file_run(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of the run with the newest file; of equals the newest run.

    Holds all rows of the batch that ``latest_batch`` with a leading file stamp selects.
    """
    index = RunIndex(spark, path)
    if not index.stamps():
        return read_table(spark, path, schema)
    run = index.newest_file()
    return spark.createDataFrame([], schema) if run is None else read_run(spark, path, schema, run)
