"""Exact dedup by two-pass Bloom filtering.

Pass one reads the text hashes. Every task marks each of its distinct hashes at
``HASHES`` slots of a filter and notes slots that were touched twice; the notes are
merged by ranges of the filter, one range a group, with a memory that the range bounds.
Pass two asks the merged filter: a hash that any of its slots saw once only cannot be
repeated, so its row passes straight through. The others, all true repeats and a few
false alarms, shuffle by digest, are summed per task first, and are decided exactly.

The filter that is broadcast has 16 bits a row, rounded up to a power of two, and at
most ``max_bits``. More rows than that are dealt by a range of their hash into folders,
and each range has its two passes and a filter of its own, one after the other: the share
of rows that shuffle for nothing is the same at every size, and so is the broadcast.

Equal means identical text (equal SHA-256); null counts as empty. Of equal texts the
row with the largest id stays; null ids come last, and of rows that share that id
exactly one stays. Empty texts are equal to each other. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakebook.llm.shared import Scratch, all_columns, lookup, shared_value, stored

HASHES = 3
#: A filter is merged in so many ranges, each a group; a task sends a row per range.
RANGES = 64
#: Slots that a task holds before it sends them on.
MARK_AT_ONCE = 1 << 18
#: A range of marks needs at least eight slots, a byte of the bitmap.
MIN_BITS, MAX_BITS = 1 << 18, 1 << 28


def digest(text: Column) -> Column:
    """The text's SHA-256, 32 bytes."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _slots(digests: pd.Series, bits: int) -> np.ndarray:
    """(rows, HASHES) slots, cut from the digest itself."""
    words = np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 4)
    return words[:, :HASHES] & np.uint64(bits - 1)


def mark(slots: np.ndarray, bits: int) -> pd.DataFrame:
    """Per range of the filter, the touched slots; those touched twice stand twice."""
    slot, count = np.unique(slots.ravel(), return_counts=True)
    slot = np.repeat(slot, np.minimum(count, 2)).astype(np.uint64)
    size = np.uint64(bits // RANGES)
    part = (slot // size).astype(np.int64)
    cuts = np.flatnonzero(np.diff(part)) + 1
    low = (slot % size).astype("<u4")
    starts = np.concatenate(([0], cuts))[: len(slot)]
    return pd.DataFrame({"part": part[starts], "slots": [p.tobytes() for p in np.split(low, cuts)] if len(slot) else []})


MARKS = "part long, slots binary"


def marks(groups: Iterator[np.ndarray], bits: int) -> Iterator[pd.DataFrame]:
    """Marks of many groups of slots, a row per range for every ``MARK_AT_ONCE`` of them."""
    held, n = [], 0
    for slots in groups:
        held.append(slots)
        n += slots.size
        if n >= MARK_AT_ONCE:
            yield mark(np.concatenate(held), bits)
            held, n = [], 0
    if n:
        yield mark(np.concatenate(held), bits)


def _merge(bits: int):
    def merge(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The slots of a range that were touched at least twice, as a bitmap."""
        touched = np.zeros(bits // RANGES, dtype=np.uint8)
        for part in parts:
            for slots in part["slots"]:
                at, count = np.unique(np.frombuffer(slots, dtype="<u4"), return_counts=True)
                touched[at] = np.minimum(touched[at] + count, 2)
        twice = np.packbits(touched == 2, bitorder="little")
        if twice.any():
            yield pd.DataFrame({"part": [key[0]], "bitmap": [twice.tobytes()]})

    return merge


def touched_twice(marked: DataFrame, bits: int) -> bytes:
    """The bitmap of all slots touched at least twice: ``bits`` / 8 bytes at the driver."""
    merged = marked.groupBy("part").applyInPandas(_merge(bits), "part long, bitmap binary")
    filled = bytearray(bits // 8)
    size = bits // RANGES // 8
    for part, bitmap in merged.toLocalIterator():
        filled[part * size : (part + 1) * size] = bitmap
    return bytes(filled)


def all_set(filled: bytes, slots: np.ndarray) -> np.ndarray:
    """For each row of ``slots``, whether all of them are set."""
    held = np.frombuffer(filled, dtype=np.uint8)
    return ((held[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def filter_bits(wanted: int, max_bits: int = MAX_BITS) -> int:
    bits = MIN_BITS
    while bits < min(wanted, max_bits):
        bits *= 2
    return bits


def range_count(rows: int, max_bits: int) -> int:
    """Into how many ranges rows are dealt so that a filter of ``max_bits`` has 16 bits a row."""
    count = 1
    while 16 * rows > count * max_bits:
        count *= 2
    return min(count, 1 << 16)


def digest_range(sha: str, count: int) -> Column:
    """The range of a digest, by its last two bytes, which no slot is cut from."""
    return (F.conv(F.hex(F.substring(sha, 31, 2)), 16, 10).cast("int") % count).cast("int")


def possibly_repeated(hashed: DataFrame, max_bits: int = MAX_BITS):
    """A function of a digest column, false only where ``hashed.sha`` has it once.

    ``hashed`` is a stored table. The merged filter, at most ``max_bits`` / 8 bytes, is
    what the driver gathers and broadcasts.
    """
    bits = filter_bits(16 * hashed.count(), max_bits)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from marks((_slots(batch["sha"], bits) for batch in batches if len(batch)), bits)

    filled = touched_twice(hashed.select("sha").mapInPandas(run, MARKS), bits)
    shared = shared_value(hashed.sparkSession, filled)

    @F.pandas_udf("boolean")
    def maybe(sha: pd.Series) -> pd.Series:
        return pd.Series(all_set(shared.value, _slots(sha, bits)))

    return maybe


def duplicate_report(
    frame: DataFrame, id_col: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per document: who stays for it, its group's size, and whether it stays."""
    with Scratch(frame.sparkSession):
        hashed = frame.select(F.col(id_col).alias("doc_id"), digest(F.col(text)).alias("sha")).withColumn(
            "row", F.monotonically_increasing_id()
        )
        ranges = range_count(frame.count(), max_bits)
        if ranges > 1:
            hashed = hashed.withColumn("part", digest_range("sha", ranges))
        hashed = stored(hashed, "digests", by="part" if ranges > 1 else None)
        parts = []
        for own in _ranges(hashed, "part", ranges):
            with Scratch(frame.sparkSession):
                maybe = possibly_repeated(own, max_bits)("sha")
                parts.append(stored(own.withColumn("maybe", maybe), "flagged", outlive=True))
        flagged = parts[0] if ranges == 1 else stored(reduce(DataFrame.unionByName, parts), "flagged")
        return _decided(flagged)


def _ranges(rows: DataFrame, column: str, count: int) -> Iterator[DataFrame]:
    if count == 1:
        yield rows
    else:
        yield from (rows.where(F.col(column) == i).drop(column) for i in range(count))


def _decided(flagged: DataFrame) -> DataFrame:
    """The report, stored: rows that the filter cleared as they are, groups of the others."""
    alone = flagged.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "sha",
    )
    suspects = flagged.where("maybe").select("doc_id", "row", "sha")
    # A struct orders nulls first, so that max takes the largest id.
    groups = suspects.groupBy("sha").agg(
        F.max(F.struct("doc_id", "row")).alias("top"), F.count("*").alias("group_size")
    )
    # Stored, so that a join too large to broadcast reads both sides plainly and Spark
    # can split a digest that a third of all rows share.
    decided = suspects.join(lookup(stored(groups, "groups")), "sha").select(
        "doc_id", F.col("top.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("top.row")).alias("kept"), "sha",
    )
    report = alone.unionByName(decided).withColumn("text_sha256", F.lower(F.hex("sha"))).drop("sha")
    return stored(report, "duplicates", outlive=True)


def drop_duplicates(
    frame: DataFrame, id_col: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """The rows that stay, with all their columns; one row of each distinct text.

    Rows that the filter clears keep their place. The others meet by digest, and each
    task passes on only the best row it has of a digest.
    """
    columns = all_columns(frame)
    hashed = frame.withColumn("_lb_sha", digest(F.col(text)))
    ranges = range_count(frame.count(), max_bits)
    if ranges == 1:
        return _one_of_each(hashed, columns, frame, id_col, max_bits)
    spark, kept = frame.sparkSession, []
    with Scratch(spark):
        dealt = stored(hashed.withColumn("_lb_part", digest_range("_lb_sha", ranges)), "ranges", by="_lb_part")
        for own in _ranges(dealt, "_lb_part", ranges):
            with Scratch(spark):
                kept.append(stored(_one_of_each(own, columns, frame, id_col, max_bits), "kept", outlive=True))
        return stored(reduce(DataFrame.unionByName, kept), "kept", outlive=True)


def _one_of_each(
    hashed: DataFrame, columns: list[Column], frame: DataFrame, id_col: str, max_bits: int
) -> DataFrame:
    maybe = possibly_repeated(stored(hashed.select(F.col("_lb_sha").alias("sha")), "digests"), max_bits)
    flagged = hashed.withColumn("_lb_maybe", maybe("_lb_sha"))
    alone = flagged.where(~F.col("_lb_maybe")).select(*columns)
    unordered = (T.MapType, T.VariantType)
    ordered = [c for c, f in zip(columns, frame.schema.fields, strict=True) if not isinstance(f.dataType, unordered)]
    best = (
        flagged.where("_lb_maybe")
        .groupBy("_lb_sha")
        .agg(F.max_by(F.struct(*columns), F.struct(id_col, *ordered)).alias("_lb_all"))
    )
    return alone.unionByName(best.select("_lb_all.*"))
