"""Columns taken from file names, event dates and batch stamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SUFFIX = ".csv"

# These run once for every landed row, on a path that may be long. They look at its end
# only; patterns would be tried at every character of it, and even a plain search costs
# some nanoseconds a byte. Spark repeats a text function wherever its result is used,
# unless a projection of its own holds it: ``with_lineage`` takes the steps one by one.


def landed_file() -> Column:
    """Name of the landed file a row was read from.

    A landed file, or the folder Spark wrote in its place, at any path depth.
    """
    end = F.substring_index(F.col("_metadata.file_path"), "/", -2)
    return landed_name(F.substring_index(end, "/", 1), F.substring_index(end, "/", -1))


def landed_name(folder: Column, name: Column) -> Column:
    """The folder if Spark wrote it in place of a landed file, else the file."""
    return F.when(_named(folder) & F.startswith(name, F.lit("part-")), folder).when(_named(name), name)


def _named(part: Column) -> Column:
    return F.endswith(part, F.lit(_SUFFIX)) & (part != _SUFFIX)


def folder_of(path: Column, name: Column) -> Column:
    """The folder that holds the file ``name``, the last part of ``path``; only the folder is searched."""
    return F.substring_index(_bytes(path, F.lit(1), F.octet_length(path) - F.octet_length(name) - 1), "/", -1)


def _bytes(text: Column, first: Column, length: Column) -> Column:
    """Part of a text by bytes, which are not counted through as characters are."""
    return F.substring(text.cast("binary"), first, length).cast("string")


def file_ref(filename: Column) -> Column:
    """Extraction date, the second part of ``subject_ref_stamp.csv``."""
    return part_after(filename, F.substring_index(filename, "_", 1))


def file_stamp(filename: Column) -> Column:
    """Generation stamp, the third part of ``subject_ref_stamp.csv``."""
    return without_suffix(part_after(filename, F.substring_index(filename, "_", 2)))


def part_after(filename: Column, head: Column) -> Column:
    """What stands between ``head``, the parts before, and the next underscore; NULL if nothing follows."""
    rest = _bytes(filename, F.octet_length(head) + 2, F.octet_length(filename))
    return F.when(head != filename, F.substring_index(rest, "_", 1))


def without_suffix(part: Column) -> Column:
    bare = _bytes(part, F.lit(1), F.octet_length(part) - len(_SUFFIX))
    return F.when(F.endswith(part, F.lit(_SUFFIX)), bare).otherwise(part)


def event_ref(created: Column) -> Column:
    """Date part of a timestamp text, without dashes."""
    return F.replace(F.substring(created, 1, 10), F.lit("-"), F.lit(""))


def version_key(lead: str) -> Column:
    """Batch key: the leading stamp followed by the other one, NULL if either is."""
    follow = {"ts_proc": "ts_file_generation", "ts_file_generation": "ts_proc"}[lead]
    return F.concat(F.col(lead), F.col(follow))
