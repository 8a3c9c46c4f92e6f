"""Collocations against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lakebook.llm import phrases
from lakebook.llm.phrases import collocations, compacted, phrase_counts

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
        yield re.findall(r"[^\x20\x09]+", piece)


def plain_counts(rows, longest):
    counts, words = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in pieces(text):
            words[lang] += len(piece)
            for size in range(1, longest + 1):
                for i in range(len(piece) - size + 1):
                    counts[lang, tuple(piece[i : i + size])] += 1
    return counts, words


def plain_collocations(rows, longest, least, top):
    counts, words = plain_counts(rows, longest)
    found = defaultdict(list)
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    absorbed = set()
    for (lang, longer), f in candidates.items():
        for size in range(2, len(longer)):
            for i in range(len(longer) - size + 1):
                part = (lang, longer[i : i + size])
                if 100 * f >= 100 * candidates[part]:
                    absorbed.add(part)
    for (lang, phrase), a in candidates.items():
        if (lang, phrase) in absorbed:
            continue
        n = words[lang]
        cuts = []
        for k in range(1, len(phrase)):
            l, r = counts[lang, phrase[:k]], counts[lang, phrase[k:]]
            cuts.append((1000 * a * n // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        found[lang].append((-score, -a, " ".join(phrase).encode(), l, r, n))
    return {
        (lang, rank, p.decode(), -a, l, r, n, -score)
        for lang, held in found.items()
        for rank, (score, a, p, l, r, n) in enumerate(sorted(held)[:top], 1)
    }


def random_rows(seed, docs=300):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "New", "York", "city", "a", "é", "你", "x-y", "b.c", "<S>", "\x1c", "\x85w"]
    passage = "Lorem ipsum dolor sit amet consectetur adipiscing elit sed"
    rows = [(None, None), ("en", None), ("en", ""), ("", "of the of the"), ("en", " \t\n.,;:!?\r\x0b\x0c")]
    for _ in range(docs):
        parts = []
        for _ in range(rng.randint(0, 40)):
            parts.append(passage if rng.random() < 0.1 else rng.choice(vocabulary[: rng.randint(2, 13)]))
            parts.append(rng.choice([" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "!?"]))
        rows.append((rng.choice(["en", "en", "de", None, "und", ""]), "".join(parts)))
    return rows + rows[-20:]


@pytest.mark.parametrize(("seed", "longest", "least", "top"), [(1, 5, 5, 10_000), (2, 3, 20, 15), (3, 2, 2, 10_000), (4, 6, 3, 40)])
def test_equals_plain_counting(spark, seed, longest, least, top):
    rows = random_rows(seed)
    frame = spark.createDataFrame(rows, "lang string, text string").withColumns(
        {c: F.lit("clash") for c in ("phrase", "n", "size", "bucket", "rank", "words")}
    )
    got = collocations(frame, longest=longest, least=least, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {tuple(r) for r in got.collect()} == plain_collocations(rows, longest, least, top)


def test_counts_of_many_buckets_and_chunks(spark, monkeypatch):
    """Small buckets and much that is hot: every flow crosses tasks."""
    monkeypatch.setattr(phrases, "BUCKET", 500)
    monkeypatch.setattr(phrases, "HOT", 40)
    rows = random_rows(5)
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(6)
    _, hot = phrases.hot_phrases(frame.selectExpr("coalesce(lang, 'und') as lang", "cast(coalesce(text, '') as binary) as text"), 4)
    assert {len(p) for found in hot.values() for p in found} == {2, 3}
    counts, words = plain_counts(rows, 4)
    expected = {(lang, len(p), " ".join(p), n) for (lang, p), n in counts.items() if n >= 4}
    expected |= {(lang, 0, None, n) for lang, n in words.items() if n}
    assert {tuple(r) for r in phrase_counts(frame, longest=4, least=4).collect()} == expected


def test_unary_paths_are_compacted(spark):
    rows = [("en", "a b c d. a b c d. x b y")]
    frame = spark.createDataFrame(rows, "lang string, text string")
    counts = phrase_counts(frame, longest=4, least=1)
    gone = {r.phrase for r in compacted(counts).collect()}
    assert {"a", "c", "d", "a b", "b c", "c d", "a b c", "b c d", "x", "y", "x b", "b y"} == gone


def test_more_than_a_few_ranks_of_words():
    """Word numbers so large that a phrase does not fit one key."""
    texts = [" ".join(f"w{i}" for i in range(9000)).encode(), b"w1 w2 w3 w4 w5 w1 w2 w3 w4 w5"]
    edges = next(phrases.edges_and_ends(texts, 5))
    assert edges.counts.sum() == 9000 - 4 + 6
    assert [row[-2:] for row in edges.of(edges.counts > 1).rows("en")] == [("w1 w2 w3 w4 w5", 3)]


def test_empty_table(spark):
    assert collocations(spark.createDataFrame([], "lang string, text string")).collect() == []
