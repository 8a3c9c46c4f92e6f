"""Full-table snapshots of a relational source, read in parallel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def snapshot_options(
    url: str,
    subject: str,
    *,
    schema: str = "public",
    split_on: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    until: tuple[str, str] | None = None,
    **connection: str,
) -> dict[str, str]:
    """Reader options for ``select *`` over one source table.

    ``until`` is a column and an SQL literal: rows beyond it, and NULLs there, wait for
    a later run.

    ``split_on`` names a numeric, date or timestamp column. Its ``bounds`` only
    set the width of the slices: rows outside them, and NULLs, are still read.
    """
    options = {
        "url": url,
        "dbtable": f"{schema}.{subject}"
        if until is None
        else f"(select * from {schema}.{subject} where {until[0]} <= {until[1]}) as {subject}",
        "fetchsize": str(fetch_size),
        **connection,
    }
    if split_on is not None:
        if bounds is None or partitions is None:
            raise ValueError("split_on needs bounds and partitions")
        options |= {
            "partitionColumn": split_on,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_snapshot(
    spark: SparkSession,
    url: str,
    subject: str,
    *,
    predicates: Sequence[str] | None = None,
    one_task: bool = False,
    **options,
) -> DataFrame:
    """All rows and columns of a source table.

    Say how it is cut: ``split_on``, or ``predicates`` for text keys, one task each,
    which together must cover every row exactly once. ``one_task`` sends everything
    through one connection into one task, which only suits small tables.

    Only a read by one task is one consistent snapshot. Slices are transactions of
    their own, each at its own moment; a table that is written meanwhile can land torn.
    ``until`` fixes an upper bound for the run, so that all slices agree on which rows
    there are as long as rows up to it no longer change.
    """
    if not one_task and predicates is None and "split_on" not in options:
        raise ValueError("give split_on, predicates, or one_task=True")
    if predicates is None:
        return spark.read.format("jdbc").options(**snapshot_options(url, subject, **options)).load()
    if "split_on" in options:
        raise ValueError("give either split_on or predicates")
    settings = snapshot_options(url, subject, **options)
    table = settings.pop("dbtable")
    return spark.read.jdbc(
        settings.pop("url"), table, predicates=list(predicates), properties=settings
    )
