"""Fill-in-middle against a plain version, and its rank index on its own."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakebook.llm.infill import ERROR, Markers, boundaries, fill_in_middle, fit_lines, predict, restored
from lakebook.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TEXTS = [
    None, "", "\n", "\n\n\n", "one line", "a\nb", "a\nb\n", "é\n你好\n\U0001f600 x\n\nend", "has <S> inside\nb\n",
    "<\nP>\n<S\n>", "M>\n<\n<M\n", "\r\nx\r\n\r\n", "line of some words\n" * 9000, "L" * 70_000, "same\ntext\n", "same\ntext\n",
    "$1 \\Q \\E $2\n.*\n", " \n\x85 \n",
]


def plain_version(doc_id, text, seed=7, percent=100, spm_percent=50, markers=("<P>", "<S>", "<M>")):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in markers) or h[2] % 100 >= percent:
        return len(lines), "plain", None, None, text
    a, b = sorted(x % (len(lines) + 1) for x in h[:2])
    prefix, middle, suffix = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    p, s, m = markers
    if h[3] % 100 < spm_percent:
        return len(lines), "spm", len(prefix), len(middle), s + suffix + p + prefix + m + middle
    return len(lines), "psm", len(prefix), len(middle), p + prefix + s + suffix + m + middle


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i, t, "x", 1, "psm") for i, t in enumerate(TEXTS)] + [(None, "a\nb\nc", "x", 1, "psm")] * 2
    rows += [(5, "a\nb", "x", 1, "psm")] * 2 + [(2**60 + 1, t, None, None, None) for t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, output string, n int, form string")


@pytest.mark.parametrize("options", [{}, {"seed": 11, "percent": 40, "spm_percent": 0}, {"spm_percent": 100}])
def test_equals_the_plain_version(texts, options):
    got = fill_in_middle(texts, **options).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
    expected = Counter((r.doc_id, *plain_version(r.doc_id, r.text, **options)) for r in texts.collect())
    assert Counter(tuple(r) for r in got.collect()) == expected


def test_restores_every_text(texts):
    back = fill_in_middle(texts).select("doc_id", restored(F.col("output"), F.col("form")).alias("text"))
    given_texts = Counter((r.doc_id, r.text or "") for r in texts.collect())
    assert Counter(tuple(r) for r in back.collect()) == given_texts


def test_other_markers(spark):
    frame = spark.createDataFrame([(i, "a\nb\nc <P>\n") for i in range(20)], "doc_id long, text string")
    markers = Markers("[pre]", "[suf]", "[mid]")
    got = fill_in_middle(frame, markers=markers).withColumn("back", restored(F.col("output"), F.col("form"), markers))
    for r in got.collect():
        assert r.back == "a\nb\nc <P>\n"
        assert r.output == plain_version(r.doc_id, r.back, markers=markers.all())[-1]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fill_in_middle(empty).collect() == []


def test_query_on_the_documents(spark):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    expected = Counter()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        n, form, prefix, middle, output = plain_version(r.doc_id, r.text)
        expected[(r.doc_id, n, form, prefix, middle, sha(output), sha(r.text or ""))] += 1
    assert Counter(tuple(r) for r in QUERIES["op11_fim"](spark, SF).collect()) == expected


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=900), st.integers(1, ERROR))
def test_lines_miss_no_offset_by_more_than_the_bound(steps, error):
    offsets = np.concatenate(([0], np.cumsum(np.array(steps, dtype=np.int64)))).astype(np.int64)
    first, start, slope = fit_lines(offsets, error)
    rest = offsets - predict(np.arange(len(offsets)), first, start, slope)
    assert np.abs(rest).max() <= error + 1
    assert first[0] == 0 and (np.diff(first) > 0).all()


def test_even_lines_need_one_fit():
    assert len(fit_lines(boundaries("twelve chars\n" * 5000))[0]) == 1
