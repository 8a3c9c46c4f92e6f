"""Sum-of-squares packing against a plain choice of levels, and its invariants."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from lakebook.llm.packing import WORD_BPE, pack_documents
from lakebook.llm.queries import QUERIES
from lakebook.llm.windows import Levels, Piece, is_power_of_two, pack_windows, split_at

SF = "/root/testdata/sf0.001"


def plain_choice(count, size, capacity):
    """The level that makes the sum of squares least, the fullest of equals; 0 opens a window."""
    best = None
    for level in range(capacity - size, -1, -1):
        if level and not count[level]:
            continue
        after = dict(enumerate(count))
        if level:
            after[level] -= 1
        if level + size < capacity:
            after[level + size] += 1
        total = sum(n * n for n in after.values())
        if best is None or total < best[0]:
            best = (total, level)
    return best[1]


@pytest.mark.parametrize("seed", range(4))
def test_choices_make_the_sum_of_squares_least(seed):
    rng, capacity = random.Random(seed), 24
    levels = Levels(capacity, max_open=10**6)
    for i in range(400):
        size = rng.choice([rng.randint(1, capacity - 1), 9, 5])
        assert levels.choose(size) == plain_choice(levels.count.tolist(), size, capacity)
        for window in levels.place(Piece(i, size, 0, bytes(4 * size))):
            assert sum(map(len, window)) == capacity
    assert levels.windows == levels.count.sum() == sum(map(len, levels.open))


def test_split_cuts_one_piece():
    window = [Piece(1, 9, 0, bytes(range(12))), Piece(2, 9, 4, bytes(range(20)))]
    left, right = split_at(window, 5)
    assert [(p.doc, p.start, len(p)) for p in left + right] == [(1, 0, 3), (2, 4, 2), (2, 6, 3)]
    assert b"".join(p.ids for p in left + right) == bytes(range(12)) + bytes(range(20))


def check(rows, expected_ids, capacity):
    """Every id once, no gap in a sequence, full or a power of two, and as few as can be."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(r.ids) and r.length * 4 == len(r.ids) > 0
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(docs) == set(expected_ids)
    for doc_id, pieces in docs.items():
        pieces.sort(key=lambda r: r.start)
        assert b"".join(p.ids for p in pieces) == expected_ids[doc_id]
        assert [p.start for p in pieces] == np.cumsum([0, *(p.length for p in pieces)])[:-1].tolist()
        assert {p.doc_tokens for p in pieces} == {len(expected_ids[doc_id]) // 4}
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        total = sum(p.length for p in pieces)
        assert [p.offset for p in pieces] == np.cumsum([0, *(p.length for p in pieces)])[:-1].tolist()
        assert total == capacity or (total < capacity and is_power_of_two(total))
        assert {p.sequence_length for p in pieces} == {total}


def library_ids(texts):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return [
        np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4").tobytes() for t in texts
    ]


@pytest.mark.parametrize("max_open", [4096, 3])
def test_documents_are_packed_whole(spark, max_open):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    rows = pack_windows(documents, with_ids=True, max_open=max_open).collect()
    held = documents.select("doc_id", "text").collect()
    check(rows, dict(zip([r.doc_id for r in held], library_ids([r.text for r in held]), strict=True)), 2048)


def test_query_pads_nothing_and_cuts_little(spark):
    rows = QUERIES["op13_packing"](spark, SF).collect()
    documents = spark.read.parquet(f"{SF}/documents.parquet").count()
    needed = sum(-(-n // 2048) for n in {r.doc_id: r.doc_tokens for r in rows}.values())
    assert len({r.doc_id for r in rows}) == documents
    # Settling cuts at most one piece a sequence, and the last window into eleven.
    assert len(rows) <= needed + len({r.sequence_id for r in rows}) + 11
    assert len(rows) < needed + documents


ODD = [
    None, "", " \n\t", "Hello, WORLD!! it's", "<|endoftext|> mid <|startoftext|>", "word " * 60_000, "x" * 9000,
    "\x1c!\x1d a\x85b 　 c", "çé İ ẞ 你好 \U0001f600", "same", "same",
]


def test_odd_texts_and_names(spark):
    rows = [(i, t, "a", 1, "b") for i, t in enumerate(ODD)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string, length int, ids string")
    check(pack_windows(frame, capacity=256, with_ids=True).collect(), dict(enumerate(library_ids(ODD))), 256)


def test_ids_pass_through_beside_nulls_and_repeats(spark):
    big = 2**53 + 1
    rows = [(big, "a b c"), (None, "d"), (None, "d"), (big + 2, "e"), (big, "a b c")]
    got = pack_windows(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), with_ids=True)
    tokens = defaultdict(int)
    for r in got.collect():
        tokens[r.doc_id] += r.length
    assert dict(tokens) == {big: 8, None: 4, big + 2: 2}


def test_empty_table(spark):
    assert pack_windows(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_a_repeated_run_gives_the_same(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").repartition(5, "doc_id")
    first, second = (sorted(map(tuple, pack_windows(documents).collect())) for _ in range(2))
    assert first == second


def test_pattern_packing_keeps_large_ids_beside_nulls_and_repeats(spark):
    big = 2**53 + 1
    rows = [(big, "a b c", 1), (None, "d", 2), (None, "d", 2), (big + 2, "e", 3), (big, "a b c", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, sequence_id long").coalesce(1)
    got = Counter((r.doc_id, r.length) for r in pack_documents(frame, capacity=64).collect())
    assert got == {(big, 4): 2, (None, 2): 2, (big + 2, 2): 1}
