"""Phrase collocations from a weighted de Bruijn graph of words.

Texts are cut into pieces at marks and line breaks, and pieces into words. The graph's
edges are the phrases of ``longest`` words; an edge leads from the node of its first words
to the node of its last ones, which the next edge overlaps. The steps:

1. Each task counts the distinct edges of some MB of text, and, as piece ends, the last
   one to ``longest - 1`` words of every piece, behind which no edge goes on.
2. Edges meet by their first two words and are summed. What flows out of a node, plus the
   pieces that end in it, is the count of the node's phrase; what flows out of the nodes of
   its first words is summed the same way, in the same task, down to single words, whose
   parts then meet once more. The texts are read once for this.
3. A node through which all flow passes along a single edge lies on a unary path. Such
   nodes are compacted into the longer phrase: it says all that they say.
4. The phrases left are scored by their weakest cut, with exact integers, and ranked.

Hot beginnings. A first pass finds the phrases of 2 to ``longest - 1`` words that hold more
than one in ``HOT`` of all words; at most 2 * ``HOT`` of each length can, so they are
broadcast. An edge is dealt by the shortest beginning that is not hot, so that no bucket
holds the edges of a common pair together, and the parts that each bucket has of a hot
phrase's count meet afterwards, one row a bucket.

Between tasks go blocks of phrases: a column of word numbers per place, with the words of
the block, compressed. Buckets are as many as the words ask for (``BUCKET``), so a task's
memory does not grow with the corpus. Phrases are compared as words, never as hashes, and
no count is approximate.

Defined cases. Null text: empty, no words. Null language: ``und``, together with rows that
say so. Repeated rows and copies count each time. Very long texts and pieces are counted
whole. Ties in score and count are ranked by the bytes of the phrase. Only two columns are
read, so others cannot clash. Empty tables, and languages without a candidate, give no rows.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakebook.llm.bpe import as_strings
from lakebook.llm.shared import Scratch, lookup, release, releasing, shared_value, small_batches, stored

LONGEST, LEAST, TOP = 5, 100, 2000
#: Bytes of text whose edges a task counts at once, and words to a bucket.
CHUNK, BUCKET = 12 << 20, 2_000_000
#: A phrase of more than one in so many words is hot.
HOT = 1000
#: Parts of a language that are ranked before the language is.
SALTS = 64

_UPPER = bytes(range(0x41, 0x5B))
_BREAKS = b".,;:!?" + bytes(range(0x0A, 0x0E))
_PLAIN = bytes.maketrans(_UPPER + _BREAKS + b"\t", _UPPER.lower() + b"\n" * len(_BREAKS) + b" ")

#: ``size`` words a phrase; a block of phrases, or (``phrase``, ``n``) of one, or, with
#: ``size`` 0, all words of a language.
ROWS = "size int, lang string, bucket int, words binary, numbers binary, counts binary, phrase string, n long"
_SCHEMA = pa.schema(
    [("size", pa.int32()), ("lang", pa.string()), ("bucket", pa.int32()), ("words", pa.binary()),
     ("numbers", pa.binary()), ("counts", pa.binary()), ("phrase", pa.string()), ("n", pa.int64())]
)
_BLOCK = ["size", "lang", "bucket", "words", "numbers", "counts"]


# Phrases of a task --------------------------------------------------------------


def _key(places: np.ndarray, words: int) -> np.ndarray:
    """A number for each phrase, the same for equal ones and in their order."""
    size = max(1, words)
    key, held = places[0].astype(np.int64), size
    for place in places[1:]:
        if held * size >= 1 << 63:
            ranks, key = np.unique(key, return_inverse=True)
            held = len(ranks)
        key = key * size + place
        held *= size
    return key


class Phrases:
    """Distinct phrases of one length: word numbers by place, words, and counts."""

    def __init__(self, places: np.ndarray, words: pa.Array, counts: np.ndarray) -> None:
        self.places, self.words, self.counts = places, words, counts

    @staticmethod
    def summed(places: np.ndarray, words: pa.Array, counts: np.ndarray | None = None) -> Phrases:
        """Equal phrases made one."""
        key = _key(places, len(words))
        order = np.argsort(key)
        key = key[order]
        starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))[: len(key)]
        if counts is None:
            total = np.diff(np.append(starts, len(key)))
        else:
            total = np.add.reduceat(counts[order], starts) if len(starts) else counts[:0]
        return Phrases(places[:, order[starts]], words, total.astype(np.int64))

    def __len__(self) -> int:
        return self.places.shape[1]

    def of(self, chosen: np.ndarray) -> Phrases:
        return Phrases(self.places[:, chosen], self.words, self.counts[chosen])

    def flow(self, ends: Phrases | None) -> Phrases:
        """The phrases less their last word, and the pieces that end with such a phrase."""
        places, counts = self.places[:-1], self.counts
        if ends is not None:
            places = np.concatenate([places, ends.places], axis=1)
            counts = np.concatenate([counts, ends.counts])
        return Phrases.summed(places, self.words, counts)

    def rows(self, lang: str) -> list[tuple]:
        """A row a phrase, as text."""
        parts = [self.words.take(pa.array(place)) for place in self.places]
        texts = pc.binary_join_element_wise(*parts, " ") if len(parts) > 1 else parts[0]
        size = len(self.places)
        return [
            (size, lang, None, None, None, None, phrase, n)
            for phrase, n in zip(texts.to_pylist(), self.counts.tolist(), strict=True)
        ]

    def blocks(self, lang: str, bucket: np.ndarray) -> Iterator[tuple]:
        """A row for each bucket that has phrases."""
        order = np.argsort(bucket, kind="stable")
        at = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        slot = np.empty(len(self.words), dtype=np.int64)
        for a, b in zip(at.tolist(), [*at[1:].tolist(), len(order)], strict=True):
            own = order[a:b]
            flat = self.places[:, own].ravel()
            # The last to write a word's slot stands for the word: no sort of all numbers.
            slot[flat] = each = np.arange(len(flat))
            used = np.sort(flat[slot[flat] == each])
            slot[used] = np.arange(len(used))
            yield (
                len(self.places), lang, int(bucket[own[0]]), _packed_words(self.words.take(pa.array(used))),
                _packed(slot[flat]), _packed(self.counts[own], "<i8"), None, None,
            )


@cache
def _packer() -> zstandard.ZstdCompressor:
    """One a worker: a new one costs more than it takes to pack a small block."""
    return zstandard.ZstdCompressor(level=1)


@cache
def _unpacker() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def _packed(numbers: np.ndarray, kind: str = "<i4") -> bytes:
    """Whole numbers, byte by byte: all lowest bytes first, so that they compress."""
    planes = numbers.astype(kind).view(np.uint8).reshape(len(numbers), -1).T
    return _packer().compress(planes.tobytes())


def _unpacked(data: bytes, kind: str = "<i4") -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(_unpacker().decompress(data), dtype=np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _packed_words(words: pa.Array) -> bytes:
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), "\n")
    return _packer().compress(joined[0].as_buffer())


def _unpacked_words(data: bytes) -> pa.Array:
    joined = pa.array([_unpacker().decompress(data)], pa.binary()).cast(pa.string())
    return pc.split_pattern(joined, "\n").flatten()


def united(blocks: list[tuple[int, bytes, bytes, bytes]]) -> dict[int, Phrases]:
    """By length, the phrases of many blocks, with the same words."""
    held = [_unpacked_words(words) for _, words, _, _ in blocks]
    encoded = pa.concat_arrays(held).dictionary_encode()
    number = np.asarray(encoded.indices)
    starts = np.cumsum([0, *map(len, held)]).tolist()
    found = {}
    for size in {block[0] for block in blocks}:
        own = [i for i, block in enumerate(blocks) if block[0] == size]
        places = [number[starts[i] : starts[i + 1]][_unpacked(blocks[i][2])].reshape(size, -1) for i in own]
        counts = np.concatenate([_unpacked(blocks[i][3], "<i8") for i in own])
        found[size] = Phrases.summed(np.concatenate(places, axis=1), encoded.dictionary, counts)
    return found


def pieces_of(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, the most frequent first; word numbers in order; the piece of each)."""
    data = b"\n".join(texts).translate(_PLAIN).replace(b"\n", b" \n ")
    found = pc.split_pattern(as_strings([data]), " ").flatten().dictionary_encode()
    words, numbers = found.dictionary, np.asarray(found.indices)
    breaks = np.asarray(pc.equal(words, "\n"))[numbers]
    own = ~(breaks | np.asarray(pc.equal(words, ""))[numbers])
    piece = breaks.cumsum(dtype=np.int32)[own]
    numbers = numbers[own]
    order = np.argsort(-np.bincount(numbers, minlength=len(words)), kind="stable")
    rank = np.empty(len(words), dtype=np.int32)
    rank[order] = np.arange(len(words), dtype=np.int32)
    return words.take(pa.array(order)), rank[numbers], piece


def runs(number: np.ndarray, piece: np.ndarray, size: int) -> np.ndarray:
    """All runs of ``size`` words within a piece, by place."""
    n = len(number) - size + 1
    inside = np.flatnonzero(piece[size - 1 :] == piece[: max(0, n)])
    return np.stack([number[inside + i] for i in range(size)])


def edges_and_ends(texts: list[bytes], longest: int) -> Iterator[Phrases]:
    """The distinct edges of the texts, and the words that pieces end with."""
    words, number, piece = pieces_of(texts)
    yield Phrases.summed(runs(number, piece, longest), words)
    last = np.flatnonzero(np.diff(piece, append=-1))
    for size in range(1, longest):
        ends = last[last >= size - 1]
        ends = ends[piece[ends - size + 1] == piece[ends]]
        yield Phrases.summed(np.stack([number[ends - size + 1 + i] for i in range(size)]), words)


def heavy(texts: list[bytes], longest: int, all_words: int) -> Iterator[Phrases]:
    """The phrases of 2 to ``longest - 1`` words that may be hot: the runs of a phrase that
    is not hot are not either, and so each length only looks at runs that begin hot."""
    words, number, piece = pieces_of(texts)
    starts = np.arange(len(number))
    for size in range(2, longest):
        starts = starts[starts + size <= len(number)]
        starts = starts[piece[starts + size - 1] == piece[starts]]
        if not len(starts):
            return
        places = np.stack([number[starts + i] for i in range(size)])
        _, group, count = np.unique(_key(places, len(words)), return_inverse=True, return_counts=True)
        hot = (2 * HOT * count > all_words)[group]
        starts = starts[hot]
        yield Phrases.summed(places[:, hot], words)


# Dealing -----------------------------------------------------------------------

#: By language, the hot phrases, as words.
Hot = dict[str, set[tuple[str, ...]]]


def hot_flags(phrases: Phrases, hot: set[tuple[str, ...]], size: int) -> np.ndarray:
    """Whether the first ``size`` words are a hot phrase."""
    flags = np.zeros(len(phrases), dtype=bool)
    wanted = [p for p in hot if len(p) == size]
    if not wanted or not len(phrases):
        return flags
    number = np.asarray(pc.fill_null(pc.index_in(pa.array([w for p in wanted for w in p], pa.string()), phrases.words), -1))
    number = number.reshape(-1, size)
    number = number[(number >= 0).all(axis=1)]
    if not len(number):
        return flags
    own, known = phrases.places[:size], number.T.astype(phrases.places.dtype)
    key = _key(np.concatenate([own, known], axis=1), len(phrases.words))
    # The hot ones are few: only they are sorted, and each phrase is looked up among them.
    own, known = key[: len(phrases)], np.sort(key[len(phrases) :])
    return known[np.minimum(np.searchsorted(known, own), len(known) - 1)] == own


def _hashes(words: pa.Array) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words.to_pylist()], dtype=np.uint64)


def buckets_of(phrases: Phrases, hashes: np.ndarray, buckets: int, hot: set[tuple[str, ...]] | None) -> np.ndarray:
    """The bucket of each phrase: by its shortest beginning, of two words at least, that is
    not hot, or by all its words if ``hot`` is None."""
    size = len(phrases.places)
    found = np.zeros(len(phrases), dtype=np.uint64)
    going, own = phrases, slice(None)
    for i in range(size):
        mixed = (found[own] ^ hashes[going.places[i]]) * np.uint64(0x9E3779B97F4A7C15)
        found[own] = mixed ^ (mixed >> np.uint64(29))
        if hot is not None and i:
            hotter = np.flatnonzero(hot_flags(going, hot, i + 1))
            own, going = np.arange(len(phrases))[own][hotter], going.of(hotter)
    return (found % np.uint64(buckets)).astype(np.int32)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list[bytes]]]:
    """By language, texts of about ``CHUNK`` bytes."""
    held, size = defaultdict(list), 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            held[lang].append(text)
            size += len(text)
            if size >= CHUNK:
                yield held
                held, size = defaultdict(list), 0
                release()
    if held:
        yield held


def _heavy(longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What may be hot, and the number of words."""
        for chunk in _chunks(batches):
            size = {lang: len(pieces_of(texts)[1]) for lang, texts in chunk.items()}
            rows = [(0, lang, None, None, None, None, None, n) for lang, n in size.items()]
            for lang, texts in chunk.items():
                for phrases in heavy(texts, longest, sum(size.values())):
                    rows.extend(phrases.rows(lang))
            yield _batch(rows)

    return releasing(run)


def _graph(longest: int, buckets: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of edges and piece ends."""
        for chunk in _chunks(batches):
            for lang, texts in chunk.items():
                hot, hashes = shared.value.get(lang, set()), None
                for phrases in edges_and_ends(texts, longest):
                    hashes = _hashes(phrases.words) if hashes is None else hashes
                    if rows := list(phrases.blocks(lang, buckets_of(phrases, hashes, buckets, hot))):
                        yield _batch(rows)

    return releasing(run)


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, dict[int, Phrases]]]:
    held = defaultdict(list)
    for batch in batches:
        for lang, *block in zip(*(batch.column(c).to_pylist() for c in ("lang", "size", "words", "numbers", "counts")), strict=True):
            held[lang].append(tuple(block))
    for lang in list(held):
        yield lang, united(held.pop(lang))


def _flows(longest: int, buckets: int, least: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The frequent phrases of this task's buckets; of hot ones and of words, its parts."""
        for lang, ends in _by_language(batches):
            hot, hashes, phrases = shared.value.get(lang, set()), None, None
            for size in range(longest, 0, -1):
                own = ends.pop(size, None)
                phrases = own if phrases is None else phrases.flow(own)
                if phrases is None:
                    continue
                part = np.ones(len(phrases), dtype=bool)
                if size > 1:
                    part = hot_flags(phrases, hot, size) if size < longest else ~part
                    chosen = phrases.of(~part & (phrases.counts >= least))
                    if rows := chosen.rows(lang):
                        yield _batch(rows)
                if part.any():
                    hashes = _hashes(phrases.words) if hashes is None else hashes
                    parts = phrases.of(part)
                    yield _batch(list(parts.blocks(lang, buckets_of(parts, hashes, buckets, None))))

    return releasing(run)


def _totals(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The frequent ones of phrases whose parts have met, and the number of words."""
        for lang, by_size in _by_language(batches):
            rows = [row for phrases in by_size.values() for row in phrases.of(phrases.counts >= least).rows(lang)]
            if 1 in by_size:
                rows.append((0, lang, None, None, None, None, None, int(by_size[1].counts.sum())))
            if rows:
                yield _batch(rows)

    return releasing(run)


# Counts ------------------------------------------------------------------------


def hot_phrases(given: DataFrame, longest: int) -> tuple[int, Hot]:
    """The number of words of (lang, text), and the hot phrases.

    A phrase of more than one in ``HOT`` words has, where it has more than half that share
    of a chunk, at least half of that in all: so no hot one is missed, and no more than
    2 * ``HOT`` of a length are gathered.
    """
    found = stored(given.mapInArrow(_heavy(longest), ROWS).select("size", "lang", "phrase", "n"), "heavy")
    words = found.where("size = 0").agg(F.sum("n")).first()[0] or 0
    summed = found.where("size > 0").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    hot: Hot = defaultdict(set)
    for row in summed.where(2 * HOT * F.col("n") > words).collect():
        hot[row["lang"]].add(tuple(row["phrase"].split(" ")))
    return words, dict(hot)


def phrase_counts(
    frame: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST
) -> DataFrame:
    """(lang, size, phrase, n) of every phrase of up to ``longest`` words that occurs ``least``
    times or more, and for each language a row of size 0 with all its words."""
    spark = frame.sparkSession
    small_batches(spark)
    given = frame.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )
    words, hot = hot_phrases(given, longest)
    shared = shared_value(spark, hot)
    buckets = math.ceil((words + 1) / BUCKET)
    edges = given.mapInArrow(_graph(longest, buckets, shared), ROWS).select(*_BLOCK)
    flows = stored(edges.repartition(buckets, "bucket").mapInArrow(_flows(longest, buckets, least, shared), ROWS), "flows")
    parts = flows.where(F.col("bucket").isNotNull()).select(*_BLOCK)
    totals = stored(parts.repartition(buckets, "bucket").mapInArrow(_totals(least), ROWS), "totals")
    counts = flows.where(F.col("bucket").isNull()).unionByName(totals).select("lang", "size", "phrase", "n")
    summed = counts.where("size = 0").groupBy("lang", "size").agg(F.first("phrase").alias("phrase"), F.sum("n").alias("n"))
    return counts.where("size > 0").unionByName(summed)


def compacted(counts: DataFrame) -> DataFrame:
    """(lang, phrase) of nodes on a unary path: all flow goes through one longer phrase.

    An edge is one word longer than its two nodes. Where a phrase lies inside a longer one
    that is as frequent, so it does inside one of a word more.
    """
    edges = counts.where("size > 1")
    before = F.expr("substring_index(phrase, ' ', size - 1)")
    after = F.expr("substring(phrase, locate(' ', phrase) + 1)")
    flow = edges.select("lang", before.alias("phrase"), "n").unionByName(edges.select("lang", after.alias("phrase"), "n"))
    through = flow.groupBy("lang", "phrase").agg(F.max("n").alias("through"))
    return counts.join(through, ["lang", "phrase"]).where("through >= n").select("lang", "phrase")


# Scores ------------------------------------------------------------------------


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of all phrases of two words or more, each at its
    weakest cut; of equal ones at the first."""
    words = lookup(stored(counts.where("size = 0").select("lang", F.col("n").alias("all_words")), "totals"))
    parts = lookup(stored(counts.where("size > 0").select("lang", "phrase", "n"), "parts"))
    cuts = counts.where("size > 1").select(
        "lang", "phrase", F.col("n").alias("a"), F.explode(F.expr("sequence(1, size - 1)")).alias("cut")
    )
    joined = (
        cuts.withColumn("left", F.expr("substring_index(phrase, ' ', cut)"))
        .withColumn("right", F.expr("substring(phrase, length(left) + 2)"))
        .join(parts.toDF("lang", "left", "l"), ["lang", "left"])
        .join(parts.toDF("lang", "right", "r"), ["lang", "right"])
        .join(words, "lang")
    )
    # Integers of up to 38 digits; their quotient fits a long.
    score = F.expr(
        "(cast(1000 * a as decimal(19, 0)) * cast(all_words as decimal(18, 0)))"
        " div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))"
    )
    weakest = joined.groupBy("lang", "phrase", "a", "all_words").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("w"))
    return weakest.select("lang", "phrase", "a", "w.l", "w.r", F.col("all_words").alias("n"), "w.score")


def collocations(
    frame: DataFrame, text: str = "text", lang: str = "lang",
    longest: int = LONGEST, least: int = LEAST, top: int = TOP,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's ``top`` phrases.

    Parts of a language are ranked before it is, so no task sees all its phrases.
    """
    with Scratch(frame.sparkSession):
        counts = phrase_counts(frame, text, lang, longest, least)
        kept = scored(counts).join(compacted(counts), ["lang", "phrase"], "left_anti")
        best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
        salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
        first = kept.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best)))
        ranked = first.where(F.col("rank") <= top).withColumn(
            "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")
        )
        chosen = ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
        return stored(chosen, "collocations", outlive=True)
