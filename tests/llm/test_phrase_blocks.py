"""Blocks of phrases cost what their phrases do, however many buckets there are."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard

from lakebook.llm import phrases as p


def _phrases() -> p.Phrases:
    words = pa.array([f"w{i}é" for i in range(50)])
    places = np.random.default_rng(1).integers(0, 50, (3, 4000))
    return p.Phrases.summed(places, words)


def test_one_compressor_packs_all_blocks(monkeypatch):
    made, kind = [], zstandard.ZstdCompressor

    def counted(*args, **options):
        made.append(1)
        return kind(*args, **options)

    monkeypatch.setattr(zstandard, "ZstdCompressor", counted)
    given = _phrases()
    blocks = list(given.blocks("en", (np.arange(len(given)) % 97).astype(np.int32)))
    assert len(blocks) == 97 and len(made) <= 1
    found = p.united([(b[0], b[3], b[4], b[5]) for b in blocks])[3]
    assert sorted(found.rows("en")) == sorted(given.rows("en"))


def test_hot_flags_look_phrases_up():
    given = _phrases()
    texts = [r[6].split(" ") for r in given.rows("en")]
    hot = {("w1é", "w2é"), ("w3é", "w3é"), ("w1é", "elsewhere"), tuple(texts[7])}
    for size in (2, 3):
        assert p.hot_flags(given, hot, size).tolist() == [tuple(t[:size]) in hot for t in texts]
    assert not p.hot_flags(given, {("no", "such")}, 2).any()
    assert not p.hot_flags(given.of(np.arange(0)), hot, 2).any()
