"""Suffix-array dedup: removes every byte of a long string that starts elsewhere too.

Prefix doubling over the positions that may recur. The first rank of a position, of its
64 bytes, is a hash that each task reads from the text. Spark then sorts pairs of ranks at
growing offsets and numbers the distinct ones: (rank at p, rank at p + 64) gives the ranks
of 128 bytes, and two of these at offset 72 tell 200 bytes. In each round, positions
whose pair is unique are dropped, since nothing longer that starts there recurs either. The
four first ranks of a window travel in its row, so no round joins positions to positions.

To sort every position of a corpus would move it many times. Two facts keep most
positions out of the rounds, and are exact:

* A window of 200 bytes is the same as another only if the places where its least
  128-byte hash stands agree. One sampled position stands for all windows that share it
  (about one in 35 positions), and if its hash is unique, none of them recurs. Unique
  hashes are recognised by a two-pass Bloom filter, which only ever errs towards keeping;
  another one drops windows whose four first ranks are unique. Where the sampled hashes are
  too many for a filter, four bytes of each are dealt by range, and a filter is made of
  those that recur there.
* Windows in a row around the same sampled position form a stretch. If the whole
  stretch, told by a 64-bit hash of its bytes, occurs twice, all its windows recur; and
  in the rounds one member of each such class stands for all of them.

So the rounds rank only windows of stretches that differ although they share a sampled
hash: the edges of repeats. Since equal windows share it, the hash also deals the rounds into
parts, one after the other, each with a filter of its own. The bytes of the asked stretches
are taken out of the texts once, so that no part reads a text. Pairs are counted in partial
sums before they are shuffled and sorted, and rows meet their new ranks in joins of stored
tables, whose hot keys adaptive execution splits. No task holds more than a document, a
filter and its range of pairs or hashes.

Positions are bytes of the UTF-8 text, and matches never cross documents. Everything is
judged on the input. Chance agreement of two stretches needs 64 equal bits twice, that of
two windows four times.

Defined cases. Null text: empty, nothing removed. Texts shorter than the threshold:
never touched. Copies of a document, and repeated rows, remove each other whole. In
text results, bytes of a character that was cut apart are dropped. An empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakebook.llm.exact import MARKS, all_set, filter_bits, marks, range_count, touched_twice
from lakebook.llm.shared import (
    Scratch,
    all_columns,
    lookup,
    numbered,
    releasing,
    shared_value,
    small_batches,
    stored,
)

THRESHOLD = 200
MAX_BITS = 1 << 29
#: Bytes that are ranked at once; longer texts are cut into overlapping chunks.
CHUNK = 1 << 18
#: Narrow rows (a rank or two) up to which a table of ranks is broadcast.
NARROW_ROWS = 1_000_000
#: Sampled ranks that a task compares at once, four bytes each.
RANGE_RANKS = 1 << 22
#: Sampled ranks that a task holds before it sends them on.
DEAL_AT_ONCE = 1 << 20
#: The rounds go in so many parts at least, if each has ``PART_WINDOWS``, and in more where a
#: part would outgrow its filter: what they store and shuffle is that of one part at a time.
PARTS, PART_WINDOWS = 4, 1 << 23
#: Bytes of stretches in a row.
STRIP = 1 << 16
_INDEX_BITS = np.uint64(24)
_BASE = 0x9E3779B97F4A7C15


def first_length(threshold: int) -> int:
    """The length of the first ranks; doubled once and then stretched to the threshold."""
    if threshold < 8:
        raise ValueError("the threshold must be 8 bytes or more")
    return 8 * threshold // 25


# Ranks -------------------------------------------------------------------------


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64."""
    up, down = np.full(n, _BASE, dtype=np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return _mix(left * np.uint64(0xD6E8FEB86659FD93) + (right ^ (right >> np.uint64(32))))


def first_ranks(flat: np.ndarray, first: int) -> np.ndarray:
    """A hash of the ``first`` bytes from each position."""
    n = len(flat)
    if n < first:
        return np.zeros(0, dtype=np.uint64)
    up, down = _powers(max(2 * CHUNK, n) + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_byte_values()[flat] * down[:n], out=sums[1:], dtype=np.uint64)
    return _mix((sums[first:] - sums[:-first]) * up[: n - first + 1])


def doubled_hashes(flat: np.ndarray, first: int) -> np.ndarray:
    """A hash of the 2 * ``first`` bytes from each position, made of two first ranks."""
    if len(flat) < 2 * first:
        return np.zeros(0, dtype=np.uint64)
    ranks = first_ranks(flat, first)
    return _pair(ranks[: len(ranks) - first], ranks[first:])


def _least_places(ranks: np.ndarray, width: int) -> np.ndarray:
    """For each position, where the least rank of the next ``width`` stands (the first of equals)."""
    least = (ranks << _INDEX_BITS) | np.arange(len(ranks), dtype=np.uint64)
    step = 1
    while 2 * step <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if width > step:
        least = np.minimum(least[: len(least) - (width - step)], least[width - step :])
    return (least & np.uint64((1 << 24) - 1)).astype(np.int64)


class Chunks:
    """Documents joined into pieces of about ``CHUNK`` bytes, to be ranked together."""

    def __init__(self, threshold: int) -> None:
        self.threshold, self.first = threshold, first_length(threshold)

    def of(self, texts: list[bytes]) -> Iterator[tuple[bytes, list[tuple[int, int, int, int]]]]:
        """(bytes, parts); a part: document number, its place in the bytes, its place in the document, length."""
        data, parts, size = [], [], 0
        for number, text in enumerate(texts):
            if len(text) < self.threshold:
                continue
            at = 0
            while at == 0 or at + self.threshold <= len(text):
                piece = text[at : at + CHUNK + self.threshold - 1]
                parts.append((number, size, at, len(piece)))
                data.append(piece)
                size += len(piece)
                at += CHUNK
                if size >= CHUNK:
                    yield b"".join(data), parts
                    data, parts, size = [], [], 0
        if data:
            yield b"".join(data), parts

    def stretches(self, data: bytes, parts: list[tuple[int, int, int, int]]) -> tuple[np.ndarray, ...]:
        """(part, start, end, sampled place, rank), one row a stretch of window starts.

        Places count in ``data``; ``end`` is the last window start.
        """
        ranks = doubled_hashes(np.frombuffer(data, dtype=np.uint8), self.first)
        place = _least_places(ranks, self.threshold - 2 * self.first + 1)
        owner = np.full(len(place), -1, dtype=np.int64)
        for i, (_, at, _, size) in enumerate(parts):
            owner[at : at + size - self.threshold + 1] = i
        cut = np.flatnonzero((np.diff(place) != 0) | (np.diff(owner) != 0)) + 1
        start = np.concatenate(([0], cut))
        end = np.concatenate((cut, [len(place)])) - 1
        inside = owner[start] >= 0
        start, end = start[inside], end[inside]
        return owner[start], start, end, place[start], ranks[place[start]]


def _slots(ranks: np.ndarray, bits: int) -> np.ndarray:
    return np.column_stack([ranks, _mix(ranks)]) & np.uint64(bits - 1)


# Rounds ------------------------------------------------------------------------


def _marked(threshold: int, bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Round one: marks of the sampled ranks."""
        chunks = Chunks(threshold)
        sampled = (
            chunks.stretches(data, parts)[4]
            for batch in batches
            for data, parts in chunks.of([t or b"" for t in batch["text"]])
        )
        yield from marks((_slots(ranks, bits) for ranks in sampled), bits)

    return releasing(run)


DEALT = "part long, ranks binary"


def _keys(ranks: np.ndarray, ranges: int) -> np.ndarray:
    """The rank's range, a power of two of them, above 32 more of its bits."""
    return _mix(ranks) >> np.uint64(33 - ranges.bit_length())


def _dealt(threshold: int, ranges: int):
    def deal(keys: np.ndarray) -> pd.DataFrame:
        keys, count = np.unique(keys, return_counts=True)
        keys = np.repeat(keys, np.minimum(count, 2))  # however hot a rank is
        part = (keys >> np.uint64(32)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(part)) + 1
        low = np.split(keys.astype("<u4"), cuts)
        return pd.DataFrame({"part": part[np.concatenate(([0], cuts))], "ranks": [k.tobytes() for k in low]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The sampled ranks, packed by range."""
        chunks, held, n = Chunks(threshold), [], 0
        for batch in batches:
            for data, parts in chunks.of([t or b"" for t in batch["text"]]):
                held.append(_keys(chunks.stretches(data, parts)[4], ranges))
                n += len(held[-1])
                if n >= DEAL_AT_ONCE:
                    yield deal(np.concatenate(held))
                    held, n = [], 0
        if n:
            yield deal(np.concatenate(held))

    return releasing(run)


def _repeated(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of a range, the ranks that stand there twice or more, each once."""
    low = np.sort(np.concatenate([np.frombuffer(ranks, dtype="<u4") for part in parts for ranks in part["ranks"]]))
    same = low[1:][low[1:] == low[:-1]]
    if len(same):
        yield pd.DataFrame({"part": [key[0]], "ranks": [np.unique(same).tobytes()]})


def _key_marks(bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Marks of packed ranks, two each: one that is there stands for several."""
        for batch in batches:
            for part, ranks in zip(batch["part"], batch["ranks"], strict=True):
                low = np.frombuffer(ranks, dtype="<u4")
                for at in range(0, len(low), DEAL_AT_ONCE // 16):
                    slots = _slots(_mix(low[at : at + DEAL_AT_ONCE // 16] | (np.uint64(part) << np.uint64(32))), bits)
                    yield from marks([slots, slots], bits)

    return releasing(run)


def _kept_by_range(docs: DataFrame, threshold: int, total: int, max_bits: int) -> DataFrame:
    """Stored stretches whose sampled rank may be repeated, if all ranks would fill a filter.

    Few ranks recur, and a filter holds these only. If they still are too many, they are dealt
    into several filters, and the texts are read once for each.
    """
    spark, ranges = docs.sparkSession, 1
    while total // 32 > ranges * RANGE_RANKS:
        ranges *= 2
    with Scratch(spark):
        dealt = docs.mapInPandas(_dealt(threshold, ranges), DEALT)
        again = stored(dealt.groupBy("part").applyInPandas(_repeated, DEALT), "again", outlive=True)
    there = again.agg(F.sum(F.length("ranks"))).first()[0] or 0  # four bytes each
    filters, found = min(max(1, -(-2 * there // max_bits)), ranges), []
    for i in range(filters):
        with Scratch(spark):
            bits = filter_bits(2 * there // filters, max_bits)
            marked = again.where(F.col("part") % filters == i).mapInPandas(_key_marks(bits), MARKS)
            filled = shared_value(spark, touched_twice(marked, bits))
            rows = docs.mapInPandas(_kept(threshold, bits, filled, (ranges, filters, i)), STRETCHES)
            found.append(stored(rows, "stretches", outlive=True))
    return reduce(DataFrame.unionByName, found)


STRETCHES = "d binary, s int, e int, h long, x long"


def _kept(threshold: int, bits: int, filled, dealt: tuple[int, int, int] | None = None):
    """``dealt``: ranges of ranks, filters, and which of them ``filled`` is."""

    def may_recur(rank: np.ndarray) -> np.ndarray:
        if dealt is None:
            return all_set(filled.value, _slots(rank, bits))
        ranges, filters, own = dealt
        keys = _keys(rank, ranges)
        mine = (keys >> np.uint64(32)) % np.uint64(filters) == own
        return mine & all_set(filled.value, _slots(_mix(keys), bits))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Stretches whose sampled rank may be repeated."""
        chunks = Chunks(threshold)
        for batch in batches:
            ids = batch["d"].tolist()
            for data, parts in chunks.of([t or b"" for t in batch["text"]]):
                part, start, end, place, rank = chunks.stretches(data, parts)
                stay = may_recur(rank)
                part, start, end, place, rank = (v[stay] for v in (part, start, end, place, rank))
                shift = np.array([inside - at for _, at, inside, _ in parts], dtype=np.int64)
                whole = np.fromiter(
                    (
                        xxhash.xxh64_intdigest(data[a : b + threshold], c)
                        for a, b, c in zip(start.tolist(), end.tolist(), (place - start).tolist(), strict=True)
                    ),
                    dtype=np.uint64,
                    count=len(start),
                )
                numbers = [p[0] for p in parts]
                yield pd.DataFrame(
                    {
                        "d": [ids[numbers[i]] for i in part.tolist()],
                        "s": (start + shift[part]).astype(np.int32),
                        "e": (end + shift[part]).astype(np.int32),
                        "h": rank.view(np.int64),
                        "x": whole.view(np.int64),
                    }
                )

    return releasing(run)


#: A window: its document's number, where it starts, and its first ranks at ``places_of``.
WINDOWS = "n long, p int, a long, b long, a2 long, b2 long, alone boolean"
RANKS = ["a", "b", "a2", "b2"]


def places_of(threshold: int) -> list[int]:
    """Where in a window the first ranks are read: two pairs, each of neighbours.

    Each pair makes the rank of twice the first length, the pairs together that of a window.
    """
    first = first_length(threshold)
    return [0, first, threshold - 2 * first, threshold - first]


STRIPS = "part int, n binary, s binary, size binary, alone binary, data binary"


def _strips(threshold: int):
    def packed(part: int, held: list[tuple]) -> dict:
        n, s, alone, data = zip(*held, strict=True)
        return {
            "part": part,
            "n": np.array(n, dtype="<i8").tobytes(),
            "s": np.array(s, dtype="<i4").tobytes(),
            "size": np.array([len(d) for d in data], dtype="<i4").tobytes(),
            "alone": np.array(alone, dtype="?").tobytes(),
            "data": b"".join(data),
        }

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The bytes of the wanted stretches' windows, many in a row."""
        held, sizes, total, full = {}, {}, 0, []
        for batch in batches:
            for n, text, stretches in zip(batch["n"].tolist(), batch["text"], batch["wanted"], strict=True):
                for r in stretches:
                    part, data = r["k"] >> 1, text[r["s"] : r["e"] + threshold]
                    held.setdefault(part, []).append((n, r["s"], r["k"] & 1, data))
                    sizes[part] = sizes.get(part, 0) + len(data)
                    total += len(data)
                    if sizes[part] >= STRIP:
                        full.append(packed(part, held.pop(part)))
                        del sizes[part]
                    if total >= 64 * STRIP:  # in parts that are not full, too
                        yield pd.DataFrame(full + [packed(*rest) for rest in held.items()])
                        held, sizes, total, full = {}, {}, 0, []
        if total:
            yield pd.DataFrame(full + [packed(*rest) for rest in held.items()])

    return releasing(run)


def _window_ranks(strips: pd.DataFrame, threshold: int) -> Iterator[tuple]:
    """(document numbers, places, their first ranks, alone) of the windows in each row."""
    columns = ((name, kind) for name, kind in (("n", "<i8"), ("s", "<i4"), ("size", "<i4"), ("alone", "?"), ("data", "u1")))
    for n, s, size, alone, data in zip(*([np.frombuffer(v, dtype=kind) for v in strips[name]] for name, kind in columns), strict=True):
        ranks = first_ranks(data, first_length(threshold))
        count = size - (threshold - 1)
        which = np.repeat(np.arange(len(size)), count)
        inside = np.arange(len(which)) - (np.cumsum(count) - count)[which]
        places = (np.cumsum(size) - size)[which] + inside
        yield n[which], s[which] + inside, [ranks[places + shift] for shift in places_of(threshold)], alone[which]


def _window_slots(ranks: list[np.ndarray], bits: int) -> np.ndarray:
    a, b, a2, b2 = ranks
    return _slots(_pair(_pair(a, b), _pair(a2, b2)), bits)


def _window_marks(threshold: int, bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Before the rounds: marks of the windows."""
        ranked = (ranks for batch in batches for _, _, ranks, _ in _window_ranks(batch, threshold))
        yield from marks((_window_slots(ranks, bits) for ranks in ranked), bits)

    return releasing(run)


def _windows(threshold: int, bits: int, filled):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The windows that the filter leaves."""
        for batch in batches:
            for numbers, places, ranks, alone in _window_ranks(batch, threshold):
                stay = all_set(filled.value, _window_slots(ranks, bits))
                yield pd.DataFrame(
                    {
                        "n": numbers[stay],
                        "p": places[stay].astype(np.int32),
                        **{name: rank[stay].view(np.int64) for name, rank in zip(RANKS, ranks, strict=True)},
                        "alone": alone[stay].astype(bool),
                    }
                )

    return releasing(run)


RUNS = "d binary, s int, e int"
NUMBERED_RUNS = "d long, s int, e int"


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of (d, s, e), what overlaps or touches within a batch is one; ends are exclusive."""
    for batch in batches:
        if not len(batch):
            continue
        code, names = pd.factorize(batch["d"])
        s, e = batch["s"].to_numpy().astype(np.int64), batch["e"].to_numpy().astype(np.int64)
        order = np.lexsort((s, code))
        base = code[order].astype(np.int64) << 33
        s, e = base + s[order], np.maximum.accumulate(base + e[order])
        new = np.concatenate(([True], s[1:] > e[:-1]))
        last = np.concatenate((new[1:], [True]))
        low = (1 << 33) - 1
        yield pd.DataFrame(
            {
                "d": names[(s[new] >> 33)],
                "s": (s[new] & low).astype(np.int32),
                "e": (e[last] & low).astype(np.int32),
            }
        )


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("s", T.IntegerType()), T.StructField("e", T.IntegerType())])))
def _joined(starts: pd.Series, ends: pd.Series) -> pd.Series:
    """The same for the runs of a document."""
    out = []
    for s, e in zip(starts, ends, strict=True):
        order = np.argsort(s, kind="stable")
        s, e = np.asarray(s)[order], np.maximum.accumulate(np.asarray(e)[order])
        new = np.concatenate(([True], s[1:] > e[:-1]))
        last = np.concatenate((new[1:], [True]))
        out.append([{"s": int(a), "e": int(b)} for a, b in zip(s[new], e[last], strict=True)])
    return pd.Series(out, dtype=object)


def _twice(rows: DataFrame, column: str, rows_there: int, max_bits: int):
    """A function of a rank column, false only where ``rows`` has the rank once."""
    bits = filter_bits(8 * rows_there, max_bits)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from marks((_slots(batch[column].to_numpy().view(np.uint64), bits) for batch in batches), bits)

    shared = shared_value(rows.sparkSession, touched_twice(rows.select(column).mapInPandas(run, MARKS), bits))

    @F.pandas_udf("boolean")
    def maybe(ranks: pd.Series) -> pd.Series:
        return pd.Series(all_set(shared.value, _slots(ranks.to_numpy().view(np.uint64), bits)))

    return maybe


def _flagged(rows: DataFrame, column: str, max_bits: int) -> DataFrame:
    """``rows``, a stored table, with ``maybe``: false only where they have the rank once.

    Ranks beyond a filter's bits are dealt by their highest bits into ranges, each with a
    filter of its own, one after the other.
    """
    n = rows.count()
    ranges = range_count(n // 2, max_bits)  # 8 bits a rank
    if ranges == 1:
        return rows.withColumn("maybe", _twice(rows, column, n, max_bits)(column))
    part = (F.shiftrightunsigned(column, 48) % ranges).cast("int")
    dealt, found = stored(rows.withColumn("part", part), "ranges", by="part"), []
    for i in range(ranges):
        with Scratch(rows.sparkSession):
            own = dealt.where(F.col("part") == i).drop("part")
            maybe = _twice(own, column, own.count(), max_bits)(column)
            found.append(stored(own.withColumn("maybe", maybe), "flagged", outlive=True))
    return reduce(DataFrame.unionByName, found)


def _alone(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that a filter took for repeated although ``rows`` has them once; few, and stored."""
    return lookup(stored(rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n = 1").select(*keys), "alone"), NARROW_ROWS)


def doubled(windows: DataFrame) -> DataFrame:
    """A round of doubling: (n, p, a, b, alone) of the windows both of whose pairs recur.

    Spark sorts the distinct pairs of first ranks and numbers them; the numbers ``a`` and
    ``b`` are the ranks of twice the length. A pair that ``windows`` hold once has no number,
    and its window is dropped: all that contains it is unique. ``windows`` is a stored table.
    """
    pairs = windows.select("a", "b").unionByName(windows.select(F.col("a2").alias("a"), F.col("b2").alias("b")))
    with Scratch(windows.sparkSession):
        again = stored(pairs.groupBy("a", "b").agg(F.count("*").alias("times")).where("times > 1"), "pairs")
        ranked = numbered(again.select("a", "b"), [F.col("a"), F.col("b")], "rank")
    ranks = lookup(ranked, NARROW_ROWS)
    second = ranks.select(F.col("a").alias("a2"), F.col("b").alias("b2"), F.col("rank").alias("rank2"))
    return (
        windows.join(ranks, ["a", "b"])
        .drop("a", "b")
        .join(second, ["a2", "b2"])
        .select("n", "p", F.col("rank").alias("a"), F.col("rank2").alias("b"), "alone")
    )


def repeated_spans(docs: DataFrame, threshold: int = THRESHOLD, max_bits: int = MAX_BITS) -> DataFrame:
    """(d, spans) of the documents that have repeats; ``docs`` has (d binary, text binary).

    ``d`` names a row by its content, so that all passes over ``docs`` agree on it. Each
    round first drops what a filter knows to be unique, then counts the rest exactly and
    joins only the filter's few false alarms.
    """
    with Scratch(docs.sparkSession) as scratch:
        spark = scratch.spark
        with Scratch(spark):
            total = docs.agg(F.sum(F.length("text"))).first()[0] or 0
            if total // 4 <= max_bits:
                bits = filter_bits(total // 4, max_bits)
                filled = shared_value(spark, touched_twice(docs.mapInPandas(_marked(threshold, bits), MARKS), bits))
                kept = stored(docs.mapInPandas(_kept(threshold, bits, filled), STRETCHES), "stretches")
            else:
                kept = _kept_by_range(docs, threshold, total, max_bits)
            # Stretches that occur twice as a whole, and the single ones.
            flagged = _flagged(kept, "x", max_bits)
            single = _alone(flagged.where("maybe"), ["h", "x"]).withColumn("once", F.lit(True))
            whole = F.col("maybe") & F.col("once").isNull()
            told = stored(
                flagged.join(single, ["h", "x"], "left").select("d", "s", "e", "h", "x", whole.alias("whole")),
                "told",
                outlive=True,
            )
        edge = stored(told.where("not whole").select("d", "s", "e", "h"), "edges")
        # A single stretch can share windows with others of its sampled rank: with single
        # ones, and with one of each class that occurs as a whole.
        ranks = lookup(stored(edge.select("h").distinct(), "ranks"), NARROW_ROWS)
        others = (
            told.where("whole").join(ranks, "h", "left_semi").groupBy("h", "x").agg(F.min(F.struct("d", "s", "e")).alias("one"))
        )
        asked = stored(
            edge.select("d", "s", "e", "h", F.lit(1).alias("alone")).unionByName(
                others.select("one.d", "one.s", "one.e", "h", F.lit(0).alias("alone"))
            ),
            "asked",
        )
        n_windows = asked.agg(F.sum(F.col("e") - F.col("s") + 1)).first()[0] or 0
        parts = max(-(-8 * n_windows // max_bits), min(PARTS, n_windows // PART_WINDOWS), 1)
        part = F.pmod("h", F.lit(parts)).cast("int")
        wanted = stored(
            asked.select("d", F.struct("s", "e", (2 * part + F.col("alone")).alias("k")).alias("r"))
            .groupBy("d")
            .agg(F.collect_list("r").alias("wanted"))
            .withColumn("n", F.monotonically_increasing_id()),
            "wanted",
        )
        sizes = asked.groupBy(part.alias("part")).agg(F.sum(F.col("e") - F.col("s") + 1).alias("n")).collect()
        with Scratch(spark):
            found = [spark.createDataFrame([], NUMBERED_RUNS)]
            with Scratch(spark):
                taken = docs.join(lookup(wanted), "d").mapInPandas(_strips(threshold), STRIPS)
                strips = stored(taken, "strips", outlive=True, by="part", compression="zstd")
            for part, n in sorted(sizes):
                with Scratch(spark):
                    own = strips.where(F.col("part") == part)
                    bits = filter_bits(8 * n, max_bits)
                    last = shared_value(spark, touched_twice(own.mapInPandas(_window_marks(threshold, bits), MARKS), bits))
                    windows = stored(own.mapInPandas(_windows(threshold, bits, last), WINDOWS), "windows")
                    # The rounds: pairs at the first offset are ranked, and pairs of these told apart.
                    ranked = stored(doubled(windows), "ranked")
                    again = ranked.where("alone").join(_alone(ranked, ["a", "b"]), ["a", "b"], "left_anti")
                    # In order, so that a document's windows are few runs before they meet its name.
                    starts = again.select(F.col("n").alias("d"), F.col("p").alias("s")).repartition("d").sortWithinPartitions("d", "s")
                    runs = starts.withColumn("e", F.col("s") + threshold).mapInPandas(_runs, NUMBERED_RUNS)
                    found.append(stored(runs, "found", outlive=True))
            found = stored(reduce(DataFrame.unionByName, found), "found", outlive=True)
        names = lookup(wanted.select("n", F.col("d").alias("name")))
        numbered_runs = found.withColumnRenamed("d", "n").join(names, "n")
        runs = numbered_runs.select(F.col("name").alias("d"), "s", "e").unionByName(
            told.where("whole").select("d", "s", (F.col("e") + threshold).alias("e")).mapInPandas(_runs, RUNS)
        )
        spans = runs.distinct().groupBy("d").agg(F.collect_list(F.struct("s", "e")).alias("r"))
        return stored(spans.select("d", _joined(F.col("r.s"), F.col("r.e")).alias("spans")), "spans", outlive=True)


# Operator ----------------------------------------------------------------------


def _row_name(id_col: str, text: Column) -> Column:
    own = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    # The id's length first: no colon in a text id can make two rows share a name.
    named = F.concat(F.concat(F.length(own).cast("string"), F.lit(":"), own).cast("binary"), text)
    return F.unhex(F.md5(named))


@F.pandas_udf(T.BinaryType())
def _without(texts: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for text, cut in zip(texts, spans, strict=True):
        if cut is None or not len(cut):
            out.append(text)
            continue
        at, parts = 0, []
        for r in cut:
            parts.append(text[at : r["s"]])
            at = r["e"]
        parts.append(text[at:])
        out.append(b"".join(parts))
    return pd.Series(out, dtype=object)


def remove_repeats(frame: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """All columns, and ``_lb_bytes``, ``_lb_spans`` (null: none) and ``_lb_kept`` (binary)."""
    small_batches(frame.sparkSession)
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    named = frame.withColumn("_lb_d", _row_name(id_col, raw))
    spans = repeated_spans(named.select(F.col("_lb_d").alias("d"), raw.alias("text")), threshold)
    found = lookup(spans.select(F.col("d").alias("_lb_d"), F.col("spans").alias("_lb_spans")))
    # The bytes come after the join, which a text crosses once if it is shuffled.
    return (
        named.join(found, "_lb_d", "left")
        .withColumn("_lb_bytes", raw)
        .withColumn("_lb_kept", _without(F.col("_lb_bytes"), F.col("_lb_spans")))
        .select(*all_columns(frame), "_lb_bytes", "_lb_spans", "_lb_kept")
    )


def repeat_report(frame: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, spans, kept) of every document."""
    return remove_repeats(frame, id_col, text, threshold).select(
        F.col(id_col).alias("doc_id"),
        F.length("_lb_bytes").cast("long").alias("n_bytes"),
        (F.length("_lb_bytes") - F.length("_lb_kept")).cast("long").alias("n_removed"),
        F.coalesce(F.size("_lb_spans"), F.lit(0)).cast("long").alias("n_spans"),
        F.col("_lb_spans").alias("spans"),
        F.col("_lb_kept").alias("kept"),
    )


def without_repeats(frame: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """All rows and columns, the text without its repeated strings; null stays null."""

    @F.pandas_udf("string")
    def whole_characters(kept: pd.Series) -> pd.Series:
        return pd.Series([k.decode("utf-8", "ignore") for k in kept], dtype=object)

    cut = remove_repeats(frame, id_col, text, threshold)
    changed = F.when(F.col("_lb_spans").isNotNull(), whole_characters("_lb_kept")).otherwise(F.col(text))
    return cut.withColumn(text, changed).select(*all_columns(frame))
