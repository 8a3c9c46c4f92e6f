"""The rounds of prefix doubling against strings compared as they are."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from lakebook.llm import suffix


def windows_of(spark, texts: list[bytes], threshold: int):
    first, rows = suffix.first_length(threshold), []
    for n, text in enumerate(texts):
        ranks = suffix.first_ranks(np.frombuffer(text, dtype=np.uint8), first).view(np.int64)
        for p in range(len(text) - threshold + 1):
            rows.append((n, p, *(int(ranks[p + shift]) for shift in suffix.places_of(threshold)), True))
    return spark.createDataFrame(rows, suffix.WINDOWS)


@pytest.mark.parametrize("threshold", [8, 13, 25, 40])
def test_pairs_that_recur_are_ranked_alike(spark, threshold):
    draw = np.random.default_rng(threshold)
    texts = [bytes(draw.integers(97, 99, 60, dtype=np.uint8)) for _ in range(6)]
    texts += [texts[0], texts[1][5:50] + texts[2][:30], b"a" * 70]
    got = {(r.n, r.p): (r.a, r.b) for r in suffix.doubled(windows_of(spark, texts, threshold)).collect()}

    first = suffix.first_length(threshold)
    shift, size = threshold - 2 * first, 2 * first
    starts = [(n, p) for n, text in enumerate(texts) for p in range(len(text) - threshold + 1)]
    seen = {(n, p): (texts[n][p : p + size], texts[n][p + shift : p + shift + size]) for n, p in starts}
    times = Counter(half for halves in seen.values() for half in halves)
    assert set(got) == {at for at, (left, right) in seen.items() if times[left] > 1 and times[right] > 1}
    rank_of = {}
    for at, ranks in got.items():
        for half, rank in zip(seen[at], ranks, strict=True):
            assert rank_of.setdefault(half, rank) == rank
    assert sorted(rank_of.values()) == sorted(set(rank_of.values()))
    assert max(rank_of.values(), default=0) < sum(n > 1 for n in times.values())
    # The pairs of new ranks tell windows of the whole threshold apart.
    whole = Counter(texts[n][p : p + threshold] for n, p in starts)
    pairs = Counter(got.values())
    for n, p in starts:
        again = (n, p) in got and pairs[got[n, p]] > 1
        assert again == (whole[texts[n][p : p + threshold]] > 1)


def test_one_pair_holds_nearly_all_rows_and_none_are_there(spark):
    rows = [(i, 0, 1, 2, 1, 2, True) for i in range(3000)] + [(3000, 0, 3, 4, 1, 2, True)]
    got = suffix.doubled(spark.createDataFrame(rows, suffix.WINDOWS)).collect()
    assert {(r.a, r.b) for r in got} == {(0, 0)} and len(got) == 3000
    assert suffix.doubled(spark.createDataFrame([], suffix.WINDOWS)).collect() == []
