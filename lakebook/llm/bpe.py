"""BPE encoding by a table of frequent words, and decoding by a list of pieces.

A byte-level BPE never merges across the start of a run of white space, so a text's ids
are those of its words, each word being a run of white space and what follows it. Spark
splits all texts into words and counts the distinct ones; each word of the table is
encoded once, and tasks look its ids up in the order of the words. The table holds
the ``table_words`` most frequent words of up to ``WORD_BYTES`` bytes and is broadcast,
so its size is bounded by these two parameters. Words beyond it, the long tail, are
encoded where they stand, in each task and again once it forgot them: to join them would shuffle every occurrence
with its position, many times the text, to save encoding words that are nearly all
alone. Decoding looks ids up in a list of the vocabulary within a UDF; nothing is joined.

Within a task words never become Python objects one by one: Arrow splits a group of
texts and numbers its distinct words, and numpy gathers their ids in order.

Ids are little-endian unsigned 32-bit integers in one binary column; ``as_array`` turns
them into an array. White space that not all engines call so (U+0085, U+00A0 and the
like) never ends a word here, which leaves longer words but the same ids.

Defined cases. Null text: empty, no ids, decoded to the empty text. A special token's
string within a text is that token. Bytes that are no UTF-8 decode to U+FFFD. An empty
table gives no rows.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakebook.llm.shared import small_batches, stored

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
TABLE_WORDS = 200_000
WORD_BYTES = 64
#: Words whose ids a task remembers beside the table.
REMEMBER = 300_000
#: Words whose ids are put together at once.
GATHERED = 1 << 16
#: Bytes of text that are split and encoded at once.
AT_ONCE = 4 << 20

_WORDS = re.compile(rb"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
_OTHER = rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe1\xa0\x8e|\xe2\x80[\x80-\x8f\xa8\xa9\xaf]|\xe2\x81[\x9f\xa0]|\xe3\x80\x80|\xef\xbb\xbf"
_HAS_OTHER = re.compile(_OTHER)
_AFTER_BLANK = re.compile(rb" [^ \t-\r]+\Z")
_AFTER_OTHER = re.compile(rb"(?:" + _OTHER + rb")\Z")


def split_words(text: bytes) -> list[bytes]:
    """The words, which joined are the text."""
    words = _WORDS.findall(text)
    if not _HAS_OTHER.search(text):
        return words
    joined: list[bytes] = []
    for word in words:
        if joined and _AFTER_OTHER.search(joined[-1]):
            joined[-1] += word
        else:
            joined.append(word)
    return joined


@lru_cache(maxsize=4)
def load(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


Ids = tuple[np.ndarray, np.ndarray]  # all ids in a row, and how many each word has


#: Words that go to the tokenizer in a call, and words joined to a text there: its results
#: take some hundred bytes a token until their ids are read.
CALL_WORDS, JOINED_WORDS = 1 << 14, 512


def encode_words(tokenizer: Tokenizer, words: list[str]) -> Ids:
    ids, sizes = [np.zeros(0, dtype="<u4")], [np.zeros(0, dtype=np.int64)]
    for at in range(0, len(words), CALL_WORDS):
        found = [e.ids for e in tokenizer.encode_batch_fast(words[at : at + CALL_WORDS], add_special_tokens=False)]
        sizes.append(np.fromiter(map(len, found), dtype=np.int64, count=len(found)))
        ids.append(np.fromiter(chain.from_iterable(found), dtype="<u4", count=int(sizes[-1].sum())))
    return np.concatenate(ids), np.concatenate(sizes)


def encode_joined(tokenizer: Tokenizer, words: list[str], joiner: str, edge: np.ndarray, at_end: bool) -> Ids:
    """The same for words that stay pieces apart when joined, some hundred a text.

    ``edge`` tells of each id whether it starts (or, ``at_end``, ends) a word. Where the
    edges found are not as many as the words, these are encoded one by one.
    """
    ids, sizes = [np.zeros(0, dtype="<u4")], [np.zeros(0, dtype=np.int64)]
    for first in range(0, len(words), CALL_WORDS):
        called = words[first : first + CALL_WORDS]
        groups = [called[at : at + JOINED_WORDS] for at in range(0, len(called), JOINED_WORDS)]
        encoded = tokenizer.encode_batch_fast([joiner.join(g) for g in groups], add_special_tokens=False)
        for group, found in zip(groups, encoded, strict=True):
            own = np.array(found.ids, dtype="<u4")
            at = np.flatnonzero(edge[own])
            if len(at) != len(group):
                own, size = encode_words(tokenizer, group)
            elif at_end:
                size = np.diff(at, prepend=-1)
            else:
                size = np.diff(at, append=len(own))
            ids.append(own)
            sizes.append(size)
    return np.concatenate(ids), np.concatenate(sizes)


@lru_cache(maxsize=4)
def _starts_with_blank(path: str) -> np.ndarray:
    return np.array([piece.startswith(b" ") for piece in pieces(path)])


def encode_after_blank(path: str, words: list[str]) -> Ids:
    """Ids of words that hold no blank, each with a blank before it."""
    plain = [w for w in words if w and "<|" not in w]
    ids, sizes = encode_joined(load(path), [" " + w for w in plain], "", _starts_with_blank(path), False)
    if len(plain) == len(words):
        return ids, sizes
    other = [w for w in words if not (w and "<|" not in w)]
    more, more_sizes = encode_words(load(path), [" " + w for w in other])
    return in_order(words, [(plain, ids, sizes), (other, more, more_sizes)])


def in_order(words: list[str], found: list[tuple[list[str], np.ndarray, np.ndarray]]) -> Ids:
    """Ids of distinct words that were encoded in several sets, in the order of ``words``."""
    pool = IdPool()
    for own, ids, sizes in found:
        pool.add(own, ids, sizes)
    numbers = np.fromiter(map(pool.number.__getitem__, words), dtype=np.int64, count=len(words))
    return pool.gather(numbers)[0], pool.size[numbers]


_BESIDE_BLANK = [pair for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r") for pair in (b" " + c, c + b" ")]
_HINTS = [b"\x1c", b"\x1d", b"\x1e", b"\x1f", b"\xc2\x85", b"\xc2\xa0", b"\xe1", b"\xe2", b"\xe3\x80\x80", b"\xef\xbb\xbf"]


def is_even(text: bytes) -> bool:
    """Whether blanks cut a text into words: no other white space stands beside a blank, and
    none that engines disagree on stands anywhere."""
    if any(pair in text for pair in _BESIDE_BLANK):
        return False
    return not (any(hint in text for hint in _HINTS) and _HAS_OTHER.search(text))


def in_groups(rows: list, size: Callable = len) -> Iterator[list]:
    """Rows in groups of about ``AT_ONCE`` bytes."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += size(row)
        if total >= AT_ONCE:
            yield held
            held, total = [], 0
    if held:
        yield held


def as_strings(texts: list[bytes] | pa.Array) -> pa.Array:
    held = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.binary())
    try:
        return held.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([t.decode("utf-8", "replace") for t in held.to_pylist()], pa.string())


class IdPool:
    """The ids of all words met, side by side, to be gathered by word number."""

    def __init__(self, remember: int = REMEMBER) -> None:
        self.remember, self.fixed = remember, 0
        self.number: dict = {}
        self.start, self.size = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype="<u4")

    def add(self, words: list, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.number.update(zip(words, range(len(self.size), len(self.size) + len(words)), strict=True))
        self.start = np.concatenate([self.start, len(self.ids) + sizes.cumsum() - sizes])
        self.size, self.ids = np.concatenate([self.size, sizes]), np.concatenate([self.ids, ids])

    def fix(self) -> None:
        """Keep the words added so far for good."""
        self.fixed = len(self.size)

    def trim(self) -> None:
        """Forget words beyond the bound; word numbers given out before no longer hold."""
        if len(self.number) <= self.fixed + self.remember:
            return
        self.number = {w: i for w, i in self.number.items() if i < self.fixed}
        end = int(self.start[self.fixed - 1] + self.size[self.fixed - 1]) if self.fixed else 0
        self.start, self.size, self.ids = self.start[: self.fixed], self.size[: self.fixed], self.ids[:end]

    def numbers(self, words: list, encode: Callable[[list], Ids]) -> np.ndarray:
        """The numbers of distinct words; those not met before are encoded now."""
        found = list(map(self.number.get, words))
        new = [w for w, i in zip(words, found, strict=True) if i is None]
        if new:
            self.add(new, *encode(new))
            found = list(map(self.number.get, words))
        return np.array(found, dtype=np.int64)

    def gather(self, numbers: np.ndarray) -> Ids:
        """The ids of words in a row, and where each word's ids end."""
        size = self.size[numbers]
        ends = size.cumsum()
        out = np.empty(int(ends[-1]) if len(ends) else 0, dtype="<u4")
        for at in range(0, len(numbers), GATHERED):
            own, end = size[at : at + GATHERED], ends[at : at + GATHERED]
            first, last = int(end[0] - own[0]), int(end[-1])
            shift = np.repeat(self.start[numbers[at : at + GATHERED]] - (end - own), own)
            out[first:last] = self.ids[shift + np.arange(first, last)]
        return out, ends


def split_at_blanks(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of even texts, less the blank before each, and where each text's begin.

    A text's first word has no blank before it.
    """
    lists = pc.split_pattern(as_strings(texts), " ")
    return lists.flatten(), np.asarray(lists.offsets)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of each group of texts."""
    for batch in batches:
        for group in in_groups([t or b"" for t in batch.column("text").to_pylist()]):
            even = [is_even(t) for t in group]
            words, begins = split_at_blanks([t for t, e in zip(group, even, strict=True) if e])
            after_blank = np.ones(len(words), dtype=bool)
            after_blank[begins[:-1]] = False
            others = [w[1:] for t, e in zip(group, even, strict=True) if not e for w in split_words(t) if _AFTER_BLANK.match(w)]
            for found in (words.filter(pa.array(after_blank)), as_strings(others)):
                counted = found.value_counts()
                short = counted.filter(pc.less_equal(pc.binary_length(counted.field("values")), WORD_BYTES))
                yield pa.RecordBatch.from_arrays([short.field("values"), short.field("counts")], ["word", "n"])


def word_table(texts: DataFrame, path: str, size: int = TABLE_WORDS) -> dict[str, bytes]:
    """Ids of the most frequent words of ``texts`` (text, as binary): at most ``size``.

    The table holds words that follow a blank, without it; most words do. Words alone in the corpus need no table. Of the others, those from the lowest count
    on that keeps the table within ``size``; a histogram of the counts tells which.
    """
    counted = texts.mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    repeated = stored(counted.where("n > 1"), "words")
    least, total = None, 0
    for row in sorted(repeated.groupBy("n").agg(F.count("*").alias("words")).collect(), key=lambda r: -r["n"]):
        total += row["words"]
        if total > size:
            break
        least = row["n"]
    if least is None:
        return {}

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = batch["word"].tolist()
            ids, sizes = encode_after_blank(path, words)
            yield pd.DataFrame({"word": words, "ids": [part.tobytes() for part in np.split(ids, sizes.cumsum()[:-1])]})

    encoded = repeated.where(F.col("n") >= least).select("word").mapInPandas(encode, "word string, ids binary")
    return {word: bytes(ids) for word, ids in encoded.collect()}


_pools: dict[str, IdPool] = {}


def _pool(name: str, shared) -> IdPool:
    """This worker's pool, filled from the broadcast table once. Keys: (word, after a blank)."""
    if name not in _pools:
        _pools.clear()
        pool = IdPool()
        ids = list(shared.value.values())
        sizes = np.array([len(i) // 4 for i in ids], dtype=np.int64)
        pool.add(list(shared.value), np.frombuffer(b"".join(ids), dtype="<u4"), sizes)
        pool.fix()
        _pools[name] = pool
    return _pools[name]


class Encoder:
    """Joins ids to the words of texts. Words after a blank are keys of the pool without it;
    other words are keys marked by a character that no text holds."""

    MARK = "\udc00"

    def __init__(self, pool: IdPool, path: str) -> None:
        self.pool, self.path = pool, path

    def _after_blank(self, words: list[str]) -> np.ndarray:
        return self.pool.numbers(words, lambda new: encode_after_blank(self.path, new))

    def _as_they_are(self, words: list[str]) -> np.ndarray:
        marked = [self.MARK + w for w in words]
        return self.pool.numbers(marked, lambda new: encode_words(load(self.path), [w[1:] for w in new]))

    def _even(self, texts: list[bytes]) -> list[bytes]:
        words, begins = split_at_blanks(texts)
        encoded = words.dictionary_encode()
        numbers = self._after_blank(encoded.dictionary.to_pylist())[np.asarray(encoded.indices)]
        firsts = words.take(pa.array(begins[:-1])).dictionary_encode()
        numbers[begins[:-1]] = self._as_they_are(firsts.dictionary.to_pylist())[np.asarray(firsts.indices)]
        ids, ends = self.pool.gather(numbers)
        data, cuts = ids.tobytes(), (4 * ends[begins[1:] - 1]).tolist()
        return [data[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]

    def _uneven(self, text: bytes) -> bytes:
        words = split_words(text)
        distinct = list(set(words))
        blank = [w for w in distinct if _AFTER_BLANK.match(w)]
        other = [w for w in distinct if not _AFTER_BLANK.match(w)]
        number = dict(zip(blank, self._after_blank([w[1:].decode("utf-8", "replace") for w in blank]).tolist(), strict=True))
        number |= zip(other, self._as_they_are([w.decode("utf-8", "replace") for w in other]).tolist(), strict=True)
        return self.pool.gather(np.array([number[w] for w in words], dtype=np.int64))[0].tobytes()

    def ids(self, texts: list[bytes]) -> list[bytes]:
        self.pool.trim()
        even = [i for i, t in enumerate(texts) if t and is_even(t)]
        found = dict(zip(even, self._even([texts[i] for i in even]) if even else [], strict=True))
        return [found[i] if i in found else self._uneven(t) if t else b"" for i, t in enumerate(texts)]


def encode(text: Column, words: DataFrame, path: str = BYTE_BPE, size: int = TABLE_WORDS) -> Column:
    """The ids of ``text``; the word table is made from ``words`` (text, as binary)."""
    shared = words.sparkSession.sparkContext.broadcast(word_table(words, path, size))
    name = uuid.uuid4().hex

    @F.pandas_udf("binary")
    def of(texts: pd.Series) -> pd.Series:
        encoder = Encoder(_pool(name, shared), path)
        groups = in_groups([t or b"" for t in texts])
        return pd.Series([ids for group in groups for ids in encoder.ids(group)], dtype=object)

    return of(text.cast("binary"))


# Decoding ----------------------------------------------------------------------


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves; the others follow from U+0100 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=4)
def pieces(path: str) -> list[bytes]:
    """The bytes of every id."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    to_byte = byte_characters()
    special = {t["id"]: t["content"] for t in content["added_tokens"]}
    vocabulary = content["model"]["vocab"]
    table = [b""] * (1 + max([*vocabulary.values(), *special]))
    for piece, i in vocabulary.items():
        table[i] = bytes(to_byte[c] for c in piece) if all(c in to_byte for c in piece) else piece.encode()
    for i, piece in special.items():
        table[i] = piece.encode()
    return table


def decode(ids: Column, path: str = BYTE_BPE) -> Column:
    """The text of an ids column, special tokens included."""

    @F.pandas_udf("string")
    def of(rows: pd.Series) -> pd.Series:
        piece = pieces(path).__getitem__
        return pd.Series(
            [
                b"".join(map(piece, np.frombuffer(r or b"", dtype="<u4").tolist())).decode("utf-8", "replace")
                for r in rows
            ],
            dtype=object,
        )

    return of(ids)


def as_array(ids: Column) -> Column:
    """An ids column as array<int>."""

    @F.pandas_udf("array<int>")
    def of(rows: pd.Series) -> pd.Series:
        return pd.Series([np.frombuffer(r or b"", dtype="<i4") for r in rows], dtype=object)

    return of(ids)


def encode_documents(
    frame: DataFrame, id_col: str = "doc_id", text: str = "text", path: str = BYTE_BPE, size: int = TABLE_WORDS
) -> DataFrame:
    """(doc_id, ids) of every document."""
    small_batches(frame.sparkSession)
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return frame.select(
        F.col(id_col).alias("doc_id"), encode(raw, frame.select(raw.alias("text")), path, size).alias("ids")
    )


def roundtrip(
    frame: DataFrame, id_col: str = "doc_id", text: str = "text", path: str = BYTE_BPE, size: int = TABLE_WORDS
) -> DataFrame:
    """(doc_id, ids, decoded) of every document."""
    return encode_documents(frame, id_col, text, path, size).withColumn("decoded", decode(F.col("ids"), path))
