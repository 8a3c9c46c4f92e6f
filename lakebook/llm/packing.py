"""Best-fit packing of token pieces into sequences, by patterns fitted with least squares.

Documents are encoded, ended with an end id, and only longer ones cut into pieces of a
whole sequence. Packing then works on the histogram of piece lengths, which has one row
per length and so at most ``capacity`` rows, however many documents there are:

1. Lengths are put into bins of ``BIN`` tokens. All patterns of two or three bins that
   fill a sequence, when every length counts as its bin's upper end, are enumerated.
2. Non-negative least squares (active sets) fits repeat counts of the patterns to the
   histogram; a basic solution has no more patterns than bins. Counts are rounded down
   and given the lengths that the bins hold.
3. What is left, and the room that rounding up left in the sequences, is packed longest
   first into the sequence with the least room that still fits (best fit), by length
   and room classes, not by document.

The plan, some thousand rows at most per capacity, is broadcast. Documents get their
place by their rank among the pieces of equal length: a numbering in ranges of rows, in
which a length that a third of all documents share is spread over many tasks.

Defined cases. Null text: empty, a piece of the end id alone. Equal rows are packed one
by one, and so are rows that share an id or have none; ids pass through unchanged. Very
long texts are encoded whole and cut. Other columns of the input are left out, so their
names cannot clash. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from lakebook.llm.bpe import IdPool, Ids, as_strings, encode_joined, encode_words, load
from lakebook.llm.shared import Scratch, numbered, releasing, small_batches, stored

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
CAPACITY, END_ID, BIN = 4096, 1, 16
#: Bytes of text that are encoded at once: the more, the fewer words are looked up again.
GROUP = 6 << 20
#: Words whose ids a task remembers from group to group.
REMEMBER = 150_000
_SPECIAL = "<|"
_ONLY_MARKS = r"^[!-&(-/:-@\[-`{-~]+$"
_CORE_AND_MARKS = r"(?s)^(?P<core>.*\p{L})(?P<marks>[!-&(-/:-@\[-`{-~]+)$"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# Pieces ------------------------------------------------------------------------


@lru_cache(maxsize=4)
def _ends(path: str) -> np.ndarray:
    """Whether each id ends a piece."""
    vocabulary = load(path).get_vocab(with_added_tokens=True)
    ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
    for piece, i in vocabulary.items():
        ends[i] = piece.endswith("</w>")
    return ends


@lru_cache(maxsize=4)
def _bare(path: str) -> Tokenizer:
    """The tokenizer without its normalizer, which leaves letters a to z as they are, and
    with words cut at blanks only."""
    tokenizer = Tokenizer.from_str(load(path).to_str())
    tokenizer.normalizer = normalizers.Sequence([])
    tokenizer.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    return tokenizer


def _single(parts: pa.Array) -> pa.Array:
    """Whether a part is letters only or marks only, and so a single piece. (A letter whose
    lower case is more than letters shows in the count of pieces.)"""
    return pc.or_(pc.utf8_is_alpha(parts), pc.match_substring_regex(parts, _ONLY_MARKS))


def encode_lower(path: str, words: list[str]) -> Ids:
    """Ids of distinct words in lower case. A run of marks at the end of a word, after a
    letter, is a piece of its own, so each word is the sum of two parts, the second often
    empty, and each distinct part is encoded once."""
    own = pa.array(words, pa.string())
    found = pc.extract_regex(own, _CORE_AND_MARKS)
    marks = pc.fill_null(found.field("marks"), "")
    cores = pc.if_else(found.is_valid(), found.field("core"), own)
    parts = pa.concat_arrays([cores, marks]).dictionary_encode()
    single = _single(parts.dictionary)
    letters = pc.and_(pc.utf8_is_alpha(parts.dictionary), pc.string_is_ascii(parts.dictionary))
    ends = _ends(path)
    kinds = [
        (letters, lambda own: encode_joined(_bare(path), own, " ", ends, True)),
        (pc.and_not(single, letters), lambda own: encode_joined(load(path), own, " ", ends, True)),
        (pc.invert(single), lambda own: encode_words(load(path), own)),
    ]
    pool, place = IdPool(), np.empty(len(parts.dictionary), dtype=np.int64)
    for chosen, encode in kinds:
        own = parts.dictionary.filter(chosen).to_pylist()
        place[np.asarray(chosen)] = len(pool.size) + np.arange(len(own))
        pool.add(own, *encode(own))
    numbers = place[np.asarray(parts.indices)].reshape(2, len(words))
    sizes = pool.size[numbers]
    return pool.gather(numbers.T.ravel())[0], sizes.sum(axis=0)


def _plain_ids(pool: IdPool, texts: pa.Array, path: str) -> Ids:
    """Ids of texts without special tokens; the tokenizer drops white space and upper case."""
    lists = pc.ascii_split_whitespace(texts)
    begins = np.asarray(lists.offsets)
    encoded = pc.ascii_lower(lists.flatten()).dictionary_encode()
    del lists
    numbers = pool.numbers(encoded.dictionary.to_pylist(), lambda new: encode_lower(path, new))
    ids, ends = pool.gather(numbers.astype(np.int32)[np.asarray(encoded.indices)])
    return ids, np.concatenate(([0], ends))[begins[1:]]


def encode_texts(pool: IdPool, texts: pa.Array, path: str) -> Ids:
    """The ids of all texts in a row, and where each text's end."""
    pool.trim()
    special = np.asarray(pc.match_substring(texts, _SPECIAL))
    if not special.any():
        return _plain_ids(pool, texts, path)
    ids, ends = _plain_ids(pool, texts.filter(pa.array(~special)), path)
    more, sizes = encode_words(load(path), texts.filter(pa.array(special)).to_pylist())
    size, start = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
    size[~special], size[special] = np.diff(ends, prepend=0), sizes
    start[~special], start[special] = ends - size[~special], len(ids) + sizes.cumsum() - sizes
    both, ends = np.concatenate([ids, more]), size.cumsum()
    return both[np.repeat(start - (ends - size), size) + np.arange(size.sum())], ends


def _with_end(ids: np.ndarray, ends: np.ndarray, end_id: int) -> Ids:
    """The same with an end id behind each text."""
    after = ends + np.arange(1, len(ends) + 1)
    out = np.empty(len(ids) + len(ends), dtype="<u4")
    own = np.ones(len(out), dtype=bool)
    own[after - 1] = False
    out[own], out[after - 1] = ids, end_id
    return out, after


def token_groups(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(ids of documents, their tokens in a row, where each document's end), some MB of text each."""
    pool, held, size = IdPool(REMEMBER), [], 0

    def encoded() -> tuple[pa.Array, np.ndarray, np.ndarray]:
        doc_ids, texts = (pa.concat_arrays(column) for column in zip(*held, strict=True))
        return doc_ids, *_with_end(*encode_texts(pool, texts, path), end_id)

    for batch in batches:
        texts = as_strings(batch.column("text"))
        group = np.asarray(pc.binary_length(texts)).cumsum() // GROUP
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            held.append((batch.column("doc_id").slice(a, b - a), texts.slice(a, b - a)))
            size += held[-1][1].nbytes
            if size >= GROUP:
                yield encoded()
                held, size = [], 0
    if held:
        yield encoded()


def _pieces(path: str, capacity: int, end_id: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, ids, ends in token_groups(batches, path, end_id):
            size = np.diff(ends, prepend=0)
            parts = -(-size // capacity)
            doc = np.repeat(np.arange(len(size)), parts)
            piece = np.arange(len(doc)) - np.repeat(parts.cumsum() - parts, parts)
            start = piece * capacity
            length = np.minimum(size[doc] - start, capacity)
            at = ((ends - size)[doc] + start) * 4
            data = memoryview(ids.tobytes())
            bodies = [data[a : a + n] for a, n in zip(at.tolist(), (4 * length).tolist(), strict=True)]
            columns = [
                doc_ids.take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                pa.array([zlib.crc32(body) for body in bodies], pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns, names = [*columns, pa.array([bytes(body) for body in bodies], pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return releasing(cut)


def id_and_text(frame: DataFrame, id_col: str, text: str) -> DataFrame:
    """(doc_id long, text binary), null texts empty."""
    small_batches(frame.sparkSession)
    return frame.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")
    )


def cut_pieces(
    frame: DataFrame, id_col: str = "doc_id", text: str = "text", path: str = WORD_BPE,
    capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) and, if asked for, the ids."""
    kinds = PIECES + (", ids binary" if with_ids else "")
    return id_and_text(frame, id_col, text).mapInArrow(_pieces(path, capacity, end_id, with_ids), kinds)


# Plan --------------------------------------------------------------------------


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """The x >= 0 that makes |a x - b| least, by active sets, with few x above 0.

    The columns in use stay independent, so their normal equations are solved; columns
    of small whole numbers keep these well conditioned.
    """
    x = np.zeros(a.shape[1])
    used: list[int] = []
    for _ in range(rounds):
        slope = a.T @ (b - a[:, used] @ x[used])
        slope[used] = -np.inf
        best = int(slope.argmax())
        if slope[best] <= 1e-9:
            break
        used.append(best)
        while used:
            held = a[:, used]
            gram = held.T @ held
            gram[np.diag_indices_from(gram)] += 1e-10
            s = np.linalg.solve(gram, held.T @ b)
            low = s <= 1e-12
            if not low.any():
                x[used] = s
                break
            old = x[used]
            step = (old[low] / np.maximum(old[low] - s[low], 1e-300)).min()
            moved = old + step * (s - old)
            x[used] = moved
            gone = low & (moved <= 1e-12)
            if not gone.any():
                gone = low
            x[[used[i] for i in np.flatnonzero(gone)]] = 0
            used = [column for i, column in enumerate(used) if not gone[i]]
    return x


def patterns(units: int) -> list[tuple[int, ...]]:
    """All sets of two or three bins, counted from 1, that add up to ``units``."""
    two = [(a, units - a) for a in range(1, units // 2 + 1)]
    three = [
        (a, b, units - a - b) for a in range(1, units // 3 + 1) for b in range(a, (units - a) // 2 + 1)
    ]
    return two + three


def fit(histogram: dict[int, int], capacity: int, bin_size: int = BIN) -> dict[tuple[int, ...], int]:
    """Repeat counts of bin patterns, no more than the bins hold."""
    units = -(-capacity // bin_size)
    held = np.zeros(units + 1)
    for length, n in histogram.items():
        held[-(-length // bin_size)] += n
    choices = [p for p in patterns(units) if all(held[k] >= p.count(k) for k in p)]
    if not choices:
        return {}
    a = np.zeros((units + 1, len(choices)))
    for j, p in enumerate(choices):
        for k in p:
            a[k, j] += 1
    scale = max(1.0, held.max())
    x = nnls(a, held / scale) * scale
    left, counts = held.astype(int), {}
    for j in np.argsort(-x, kind="stable"):
        n = min(int(x[j] + 1e-6), *(left[k] // choices[j].count(k) for k in choices[j]))
        if n > 0:
            counts[choices[j]] = n
            for k in choices[j]:
                left[k] -= n
    return counts


def plan(histogram: dict[int, int], capacity: int = CAPACITY, bin_size: int = BIN) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) of all sequences: every piece of the histogram exactly once."""
    left = dict(histogram)
    rooms: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    keys: list[int] = []

    def put(lengths: tuple[int, ...], n: int) -> None:
        room = capacity - sum(lengths)
        if room not in rooms or not rooms[room]:
            if room not in keys:
                insort(keys, room)
        rooms[room].append((lengths, n))

    bins: dict[int, list[int]] = defaultdict(list)
    for length in sorted(histogram):
        bins[-(-length // bin_size)].append(length)
    for pattern, n in fit({k: v for k, v in histogram.items() if k < capacity}, capacity, bin_size).items():
        while n:
            chosen, repeats = [], n
            for k in pattern:  # the longest lengths that the bin still has
                length = next(x for x in reversed(bins[k]) if left[x] > chosen.count(x))
                chosen.append(length)
            for length in set(chosen):
                repeats = min(repeats, left[length] // chosen.count(length))
            for length in chosen:
                left[length] -= repeats
            put(tuple(chosen), repeats)
            n -= repeats
    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            at = bisect_left(keys, length)
            if at == len(keys):
                each = capacity // length
                if n >= each:
                    put((length,) * each, n // each)
                    n %= each
                else:
                    put((length,) * n, 1)
                    n = 0
                continue
            room = keys[at]
            if not rooms[room]:
                keys.pop(at)
                continue
            lengths, repeats = rooms[room].pop()
            if not rooms[room]:
                keys.pop(at)
            fits = room // length
            if n >= fits * 1 and n // fits:
                take = min(repeats, n // fits)
                put(lengths + (length,) * fits, take)
                n -= take * fits
            else:
                take = 1
                put(lengths + (length,) * n, 1)
                n = 0
            if repeats > take:
                put(lengths, repeats - take)
    return [entry for room in sorted(rooms) for entry in rooms[room]]


class Places:
    """Which sequence and offset the r-th piece of a length has under a plan."""

    def __init__(self, planned: list[tuple[tuple[int, ...], int]]) -> None:
        taken: dict[int, int] = defaultdict(int)
        rows, first = [], 0
        for lengths, repeats in planned:
            offset = 0
            for length in lengths:
                rows.append((length, taken[length], first, offset))
                taken[length] += repeats
                offset += length
            first += repeats
        rows.sort()
        self.sequences = first
        table = np.array(rows, dtype=np.int64).reshape(-1, 4)
        self.key = (table[:, 0] << 44) + table[:, 1]
        self.rank, self.first, self.offset = table[:, 1], table[:, 2], table[:, 3]

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, (length << 44) + rank, side="right") - 1
        return self.first[at] + rank - self.rank[at], self.offset[at]


# Operator ----------------------------------------------------------------------


def pack(pieces: DataFrame, capacity: int = CAPACITY, bin_size: int = BIN) -> DataFrame:
    """``pieces`` (doc_id, piece, length and more) with ``sequence_id`` and ``offset``.

    Lengths must lie between 1 and ``capacity``.
    """
    spark = pieces.sparkSession
    held = numbered(pieces, [F.col("length"), F.col("doc_id"), F.col("piece")], "_lb_number")
    histogram = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.count("*").alias("n")).collect()}
    begin, total = np.zeros(capacity + 2, dtype=np.int64), 0
    for length in sorted(histogram):
        begin[length], total = total, total + histogram[length]
    shared = spark.sparkContext.broadcast((begin, Places(plan(histogram, capacity, bin_size))))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        begins, places = shared.value
        lengths = length.to_numpy()
        sequence, offset = places.of(lengths, number.to_numpy() - begins[lengths])
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return held.withColumn("_lb_place", place("length", "_lb_number")).select(
        *pieces.columns, "_lb_place.sequence_id", "_lb_place.offset"
    )


def pack_documents(
    frame: DataFrame, id_col: str = "doc_id", text: str = "text", path: str = WORD_BPE,
    capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False,
) -> DataFrame:
    """Every piece of every document with its place; with ``with_ids`` also its ids."""
    with Scratch(frame.sparkSession):
        return pack(stored(cut_pieces(frame, id_col, text, path, capacity, end_id, with_ids), "pieces"), capacity)
