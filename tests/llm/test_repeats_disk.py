"""What operator 4 stores where the sampled ranks are too many for one filter."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakebook.llm import exact, suffix

THRESHOLD, BITS = 50, 1 << 15


@pytest.fixture
def tables(monkeypatch):
    """Few repeats in much text; filters and ranges of a few hundred ranks; rows of each stored table."""
    monkeypatch.setattr(exact, "MIN_BITS", 1 << 9)
    monkeypatch.setattr(suffix, "RANGE_RANKS", 1 << 10)
    rows, store = [], suffix.stored

    def spy(frame, purpose, *args, **options):
        out = store(frame, purpose, *args, **options)
        rows.append((purpose, out.count()))
        return out

    monkeypatch.setattr(suffix, "stored", spy)
    return rows


def docs(spark):
    draw = np.random.default_rng(5)
    texts = [bytes(draw.integers(97, 123, 4000, dtype=np.uint8)) for _ in range(60)]
    for i in range(0, 20, 2):
        texts[i] += texts[i + 1][100 + i : 400 + i]
    return texts, spark.createDataFrame([(bytes([i]), t) for i, t in enumerate(texts)], "d binary, text binary")


def expected(texts):
    seen, at = {}, {}
    for i, text in enumerate(texts):
        for p in range(len(text) - THRESHOLD + 1):
            seen.setdefault(text[p : p + THRESHOLD], []).append((i, p))
    for places in seen.values():
        for i, p in places if len(places) > 1 else ():
            at.setdefault(i, set()).update(range(p, p + THRESHOLD))
    return at


def test_what_is_stored_follows_the_repeats(spark, tables):
    texts, frame = docs(spark)
    sampled = sum(len(part[0]) for part in (suffix.Chunks(THRESHOLD).stretches(*c) for c in suffix.Chunks(THRESHOLD).of(texts)))
    got = suffix.repeated_spans(frame, THRESHOLD, BITS).collect()
    assert {r.d[0]: {p for s in r.spans for p in range(s.s, s.e)} for r in got} == expected(texts)
    assert sampled > 10_000
    assert max(n for _, n in tables) < sampled / 4, tables
    windows = [n for purpose, n in tables if purpose == "windows"]
    assert len(windows) > 1 and max(windows) < sum(windows)


def test_ranks_that_recur_fill_several_filters(spark, tables):
    texts, frame = docs(spark)
    chunks = suffix.Chunks(THRESHOLD)
    ranks = np.concatenate([chunks.stretches(*c)[4] for c in chunks.of(texts)])
    again = {rank for rank, n in zip(*np.unique(ranks.view(np.int64), return_counts=True), strict=True) if n > 1}
    kept = suffix._kept_by_range(frame, THRESHOLD, sum(map(len, texts)), 1 << 9)
    held = {r.h for r in kept.select("h").collect()}
    assert [purpose for purpose, _ in tables].count("stretches") > 1
    assert again <= held and len(held) < len(again) + len(ranks) / 4


def test_a_text_is_shuffled_once_to_meet_its_spans(spark, monkeypatch):
    monkeypatch.setattr(suffix, "lookup", lambda frame, *_: frame.hint("merge"))
    frame = spark.createDataFrame([(1, "a b c " * 60), (2, "a b c " * 60), (3, None)], "doc_id long, text string")
    cut = suffix.remove_repeats(frame)
    assert cut.columns == ["doc_id", "text", "_lb_bytes", "_lb_spans", "_lb_kept"]
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "_lb_bytes" not in plan[plan.index("Join") :]
    assert [r.k for r in cut.orderBy("doc_id").select(F.length("_lb_kept").alias("k")).collect()] == [0, 0, 0]
