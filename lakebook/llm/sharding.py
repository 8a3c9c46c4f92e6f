"""Reproducible shuffle into shards: a Feistel permutation of the global row numbers.

Rows are numbered 0 to n - 1 in the order of their keys. A balanced Feistel network
over the smallest even number of bits that holds n permutes the numbers; a value that
falls outside is sent through again (cycle walking) until it falls inside, so the
network stays a permutation of 0 to n - 1. Row r then has place p, and with it shard
p mod shards and slot p div shards: shard sizes differ by one at most, slots have no
gaps, and who knows n, the seed and r can compute both without a look at any data.

Only the columns that are asked for are sorted. The network is four keyed rounds of
integer mixing, vectorised; on average a value walks fewer than four times.

Defined cases. Null and empty texts are rows like others. Rows with equal keys keep
distinct numbers; rows equal in all keys are interchangeable. An empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakebook.llm.shared import numbered, stored

ROUNDS, SEED = 4, 20240229
_MASK64 = (1 << 64) - 1


def _round_keys(seed: int) -> list[int]:
    """One 64-bit key a round, by the SplitMix64 sequence."""
    keys, state = [], seed & _MASK64
    for _ in range(ROUNDS):
        state = (state + 0x9E3779B97F4A7C15) & _MASK64
        z = state
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & _MASK64
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & _MASK64
        keys.append(z ^ (z >> 31))
    return keys


def half_bits(n: int) -> int:
    """Bits of each half, so that both halves together count past n - 1."""
    bits = max(2, (max(n, 1) - 1).bit_length())
    return (bits + 1) // 2


def _network(values: np.ndarray, half: int, keys: list[int]) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    left, right = values >> np.uint64(half), values & mask
    for key in keys:
        mixed = right + np.uint64(key)
        mixed = (mixed ^ (mixed >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
        left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
    return (left << np.uint64(half)) | right


def permute(rows: np.ndarray, n: int, seed: int = SEED) -> np.ndarray:
    """The place of each row number below n."""
    half, keys = half_bits(n), _round_keys(seed)
    places = _network(rows.astype(np.uint64), half, keys)
    outside = np.flatnonzero(places >= n)
    while len(outside):
        places[outside] = _network(places[outside], half, keys)
        outside = outside[places[outside] >= n]
    return places.astype(np.int64)


def assign_shards(
    frame: DataFrame, order: list[Column], shards: int, seed: int = SEED
) -> DataFrame:
    """All columns, and ``row``, ``shard`` (int) and ``slot`` (long); all rows, each once.

    Columns of these three names are replaced.
    """
    rows = numbered(frame, order, "row")
    n = rows.count()

    @F.pandas_udf("long")
    def place(row: pd.Series) -> pd.Series:
        return pd.Series(permute(row.to_numpy(), n, seed))

    placed = rows.withColumn("_lb_place", place("row"))
    return placed.withColumns(
        {
            "shard": (F.col("_lb_place") % shards).cast("int"),
            "slot": F.expr(f"_lb_place div {shards}"),
        }
    ).drop("_lb_place")


def write_shards(frame: DataFrame, order: list[Column], shards: int, path: str, seed: int = SEED) -> None:
    """Write ``shard=K`` folders whose files, read by name, hold the slots in order.

    A shard is cut into ranges of slots, so that no task writes a whole shard.
    """
    assigned = stored(assign_shards(frame, order, shards, seed), "shards")
    (
        assigned.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
