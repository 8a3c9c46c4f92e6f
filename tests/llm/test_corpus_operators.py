"""WARC, suffix-array dedup, toxicity, language ID and the pipeline on small tables."""

from __future__ import annotations

import gzip
import hashlib
import io
import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakebook.llm import langid, suffix, toxicity, warc
from lakebook.llm.components import connected_components
from lakebook.llm.shared import held_out, numbered

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, _lb int"


def frame(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, "s", 1, "x", 0) for i, t in enumerate(texts)], SCHEMA)


# WARC --------------------------------------------------------------------------

LONG, OTHER = "x" * 150, "é" * 60  # 150 and 120 bytes
PAGES = [
    (5, "http://a", LONG), (3, "http://b", LONG), (9, None, LONG), (1, "http://c", "short"), (2, "u", "short"),
    (4, "bad\r\nuri", OTHER), (6, "u", OTHER), (7, "u", None), (8, "u", ""), (None, "u", LONG), (3, "http://b", LONG),
    (10, "u", "HTTP/1.1 200 OK\r\n\r\nlooks like a head\r\n\r\n" * 9),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string")


def expected_records():
    first = {}
    for page_id, _, html in PAGES:
        body = (html or "").encode()
        if len(body) >= 100 and page_id is not None:
            first[body] = min(first.get(body, page_id), page_id)
    rows = []
    for page_id, _, html in PAGES:
        body = (html or "").encode()
        own = first.get(body, page_id)
        kind = "response" if page_id == own else "revisit"
        refers = own if kind == "revisit" else None
        rows.append((page_id, len(body), hashlib.sha256(body).hexdigest(), kind, refers))
    return Counter(rows)


def test_archive_roundtrip(spark, pages, tmp_path):
    got = warc.archive_roundtrip(pages, str(tmp_path / "w"))
    assert Counter(tuple(r) for r in got.collect()) == expected_records()


def test_archive_of_no_pages(spark, pages, tmp_path):
    assert warc.archive_roundtrip(pages.limit(0), str(tmp_path / "w")).count() == 0


def test_filters_reach_the_source(spark, pages, tmp_path):
    warc.register(spark)
    path = str(tmp_path / "w")
    warc.with_revisits(pages).write.format("warc").mode("append").save(path)
    rows = spark.read.format("warc").load(path).where("record_type = 'revisit' and target_uri = 'http://a'")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan.replace("PushedFilters", "") or "record_type" not in plan.split("Scan")[0]
    assert [r.record_id for r in rows.collect()] == ["<urn:page:5>"]


class Counting(io.BytesIO):
    """Counts the bytes that are read."""

    def __init__(self, data):
        super().__init__(data)
        self.seen = 0

    def read(self, n=-1):
        out = super().read(n)
        self.seen += len(out)
        return out


@pytest.mark.parametrize("packed", [True, False])
def test_unwanted_blocks_are_skipped(packed):
    draw = random.Random(3)
    noise = bytes(draw.getrandbits(8) for _ in range(1 << 20))
    records = [
        warc.record_bytes({"WARC-Type": kind, "WARC-Record-ID": str(i)}, noise)
        for i, kind in enumerate(["response", "revisit", "response"])
    ]
    data = b"".join(warc.gzip_member(r, 1) if packed else r for r in records)
    file = Counting(data)
    found = list(warc.records(file, lambda h: h["warc-type"] == "revisit", False))
    assert [h["warc-record-id"] for _, h, _ in found] == ["1"]
    assert file.seen < 8 * warc.READ_BYTES
    blocks = list(warc.records(io.BytesIO(data), lambda h: True, True))
    assert [b for _, _, b in blocks] == [noise] * 3
    if packed:
        assert gzip.decompress(data) == b"".join(records)


def test_members_of_other_writers():
    records = [warc.record_bytes({"WARC-Type": "response", "WARC-Record-ID": str(i)}, b"abc" * i) for i in range(5)]
    for data in (b"".join(gzip.compress(r) for r in records), b"".join(records)):
        got = [(h["warc-record-id"], b) for _, h, b in warc.records(io.BytesIO(data), lambda h: True, True)]
        assert got == [(str(i), b"abc" * i) for i in range(5)]
        some = [h["warc-record-id"] for _, h, _ in warc.records(io.BytesIO(data), lambda h: h["warc-record-id"] == "3", False)]
        assert some == ["3"]


def test_files_outside_the_manifest_are_not_read(spark, pages, tmp_path):
    path = tmp_path / "w"
    before = warc.archive_roundtrip(pages, str(path)).count()
    stray = next(path.glob("*.warc.gz"))
    (path / "part-stray.warc.gz").write_bytes(stray.read_bytes())
    assert spark.read.format("warc").load(str(path)).count() == before


def test_a_cut_off_archive_is_an_error():
    whole = warc.record_bytes({"WARC-Type": "response"}, b"x" * 100)
    with pytest.raises(ValueError, match="cut off"):
        list(warc.records(io.BytesIO(whole[:-60]), lambda h: True, True))


# Suffix-array dedup ------------------------------------------------------------


def brute_spans(texts, threshold):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + threshold] for b in data for i in range(len(b) - threshold + 1))
    out = []
    for b in data:
        marked = bytearray(len(b))
        for i in range(len(b) - threshold + 1):
            if seen[b[i : i + threshold]] > 1:
                marked[i : i + threshold] = b"\1" * threshold
        spans = []
        for i, m in enumerate(marked):
            if m and (not i or not marked[i - 1]):
                spans.append([i, i + 1])
            elif m:
                spans[-1][1] = i + 1
        out.append((len(b), [tuple(s) for s in spans], bytes(x for x, m in zip(b, marked, strict=True) if not m)))
    return out


def passages(seed, threshold):
    """Texts made of shared passages with edges of all lengths, periods, and copies."""
    draw = random.Random(seed)
    letters = "abcdéß "
    noise = lambda n: "".join(draw.choice(letters) for _ in range(n))
    shared = [noise(draw.randrange(threshold // 2, 4 * threshold)) for _ in range(6)]
    texts = [None, "", "ab", "a" * (5 * threshold), "a" * threshold, "ab" * threshold, noise(threshold - 1)]
    for _ in range(40):
        parts = []
        for _ in range(draw.randrange(1, 5)):
            piece = draw.choice(shared)
            a = draw.randrange(0, len(piece) // 2)
            parts += [piece[a : draw.randrange(a, len(piece))], noise(draw.randrange(0, threshold))]
        texts.append("".join(parts))
    return texts + texts[10:13] + [shared[0]] * 3


@pytest.mark.parametrize(("seed", "threshold"), [(1, 200), (2, 40), (3, 25)])
def test_repeats_against_brute_force(spark, seed, threshold, monkeypatch):
    texts = passages(seed, threshold)
    got = {r.doc_id: r for r in suffix.repeat_report(frame(spark, texts), threshold=threshold).collect()}
    for i, (n, spans, kept) in enumerate(brute_spans(texts, threshold)):
        row = got[i]
        assert (row.n_bytes, row.n_spans, bytes(row.kept)) == (n, len(spans), kept)
        assert [tuple(s) for s in row.spans or []] == spans
        assert row.n_removed == n - len(kept)


def test_chunks_cut_long_texts_without_loss():
    """Windows of a text longer than a chunk are all owned once."""
    chunks = suffix.Chunks(200)
    draw = np.random.default_rng(1)
    text = bytes(draw.integers(97, 101, suffix.CHUNK * 2 + 5000, dtype=np.uint8))
    seen = np.zeros(len(text), dtype=int)
    for data, parts in chunks.of([b"short", text, text[:700]]):
        part, start, end, place, _ = chunks.stretches(data, parts)
        assert ((place >= start) & (place <= end + 72)).all()
        for i, a, b in zip(part.tolist(), start.tolist(), end.tolist(), strict=True):
            number, at, inside, _ = parts[i]
            if number == 1:
                seen[a - at + inside : b + 1 - at + inside] += 1
    assert (seen[: len(text) - 199] == 1).all() and not seen[len(text) - 199 :].any()


def test_removal_keeps_columns_and_whole_characters(spark):
    shared = "é" * 150
    texts = ["a" + shared + "b", "c" + shared + "d", None, "plain"]
    docs = frame(spark, texts)
    cut = suffix.without_repeats(docs)
    assert cut.columns == docs.columns
    assert {r.doc_id: r.text for r in cut.collect()} == {0: "ab", 1: "cd", 2: None, 3: "plain"}


# Toxicity ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def toxic_scores(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    return toxicity.toxicity(docs, labels, ~held_out("doc_id")).join(labels, "doc_id", "left").withColumn(
        "held", held_out("doc_id")
    ).collect()


def test_toxicity_on_held_out_rows(toxic_scores):
    rows = [r for r in toxic_scores if r.held and r.toxic is not None]
    good = sum((r.score >= 0.3) == bool(r.toxic) for r in rows) / len(rows)
    toxic = [r for r in rows if r.toxic]
    assert good > 0.92 and sum(r.score >= 0.3 for r in toxic) >= 0.6 * len(toxic)
    assert all(0 <= r.score <= 1 for r in toxic_scores)


def test_toxicity_of_odd_rows(spark):
    texts = [None, "", " ", "you idiot", "nice day"] + ["you idiot moron"] * 12 + ["a nice day"] * 30
    docs = frame(spark, texts).unionByName(frame(spark, ["you idiot"] * 2))
    labels = spark.createDataFrame(
        [(i, 0, int(5 <= i < 17)) for i in range(4, 47)] + [(None, 0, 1), (6, 0, None), (6, 0, 1)],
        "doc_id long, quality int, toxic int",
    )
    every = F.lit(True)
    got = defaultdict(list)
    for r in toxicity.toxicity(docs, labels, every).collect():
        got[r.doc_id].append(r.score)
    assert sum(map(len, got.values())) == len(texts) + 2
    assert got[3][0] > got[4][0]
    empty = toxicity.toxicity(docs, labels.limit(0), every).collect()
    assert len(empty) == len(texts) + 2 and all(0 <= r.score <= 1 for r in empty)
    assert toxicity.toxicity(docs.limit(0), labels, every).count() == 0


# Language ID -------------------------------------------------------------------


def best_path(scores, switch):
    """By trying every path."""
    from itertools import product

    paths = product(range(scores.shape[1]), repeat=len(scores))
    value = lambda p: sum(scores[i, x] for i, x in enumerate(p)) - switch * sum(a != b for a, b in zip(p, p[1:], strict=False))
    return max(map(value, paths)), value


@pytest.mark.parametrize("seed", range(12))
def test_viterbi_and_its_shortcut_find_the_best_path(seed):
    draw = np.random.default_rng(seed)
    scores = -draw.random((7, 3)) * 6
    scores -= scores.max(axis=1, keepdims=True)
    for switch in (0.5, 3.0, 9.0):
        best, value = best_path(scores, switch)
        labeller = langid.Labeller(langid.Model(["a", "b", "c"], np.zeros((langid.BUCKETS, 3)), np.ones((1, 3), bool)))
        assert value(langid.viterbi(scores, switch).tolist()) == pytest.approx(best)
        assert value(labeller.path(scores, switch).tolist()) == pytest.approx(best)


def labeller(n):
    return langid.Labeller(langid.Model([*"abcdef"[:n]], np.zeros((langid.BUCKETS, n)), np.ones((1, n), bool)))


def test_halves_in_two_languages_whose_best_overall_is_a_third():
    scores = np.array([[0, -6, -2.5]] * 4 + [[-6, 0, -2.5]] * 4)
    assert scores.sum(axis=0).argmax() == 2
    assert labeller(3).path(scores, 12.0).tolist() == [0] * 4 + [1] * 4


@pytest.mark.parametrize("seed", range(40))
def test_shortcut_equals_viterbi_on_long_runs(seed):
    draw = np.random.default_rng(seed)
    n, runs = int(draw.integers(1, 6)), int(draw.integers(1, 6))
    own = np.repeat(draw.integers(0, n, runs), draw.integers(1, 12, runs))
    scores = -draw.random((len(own), n)) * 6 * draw.random()
    scores[np.arange(len(own)), own] += draw.random() * 3
    scores = np.maximum(scores - scores.max(axis=1, keepdims=True), -langid.FLOOR)
    value = lambda p: scores[np.arange(len(p)), p].sum() - 12.0 * (np.diff(p) != 0).sum()
    assert value(labeller(n).path(scores, 12.0)) == pytest.approx(value(langid.viterbi(scores, 12.0)))


@pytest.fixture(scope="module")
def speakers(spark):
    lines = {
        "en": "the quick brown fox jumps over the lazy dog and runs through the wood with its friends",
        "de": "der schnelle braune fuchs springt über den faulen hund und läuft durch den wald",
        "ru": "быстрая коричневая лиса прыгает через ленивую собаку и бежит через лес",
    }
    rows = [(i * 3 + j, lines[k], k, "s", 1, "x", 0) for i in range(10) for j, k in enumerate(lines)]
    return spark.createDataFrame(rows, SCHEMA), lines


def test_spans_of_mixed_text(spark, speakers):
    train, lines = speakers
    text = lines["en"] + ". " + lines["de"] + "! " + lines["ru"]
    docs = frame(spark, [text, lines["de"].upper(), None, "", "123 !?", "лиса"])
    rows = {r.doc_id: r for r in langid.language_id(docs, train, spans=True).collect()}
    assert [(s.lang, text[s.start : s.end]) for s in rows[0].spans] == [(k, lines[k]) for k in ("en", "de", "ru")]
    assert rows[1].lang_pred == "de" and rows[1].score > 0.9 and rows[5].lang_pred == "ru"
    assert all((rows[i].lang_pred, rows[i].score, rows[i].spans) == ("und", 0.0, []) for i in (2, 3, 4))


def test_language_of_nothing_learned(spark, speakers):
    train, _ = speakers
    assert {r.lang_pred for r in langid.language_id(train, train.limit(0)).collect()} == {"und"}
    assert langid.language_id(train.limit(0), train).count() == 0
    nulls = train.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.language_id(train, nulls).collect()} == {"und"}


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.language_id(docs, docs.where(~held_out("doc_id"))).join(docs, "doc_id").where(held_out("doc_id")).collect()
    assert sum(r.lang == r.lang_pred for r in rows) > 0.98 * len(rows)


def test_rejected_languages_go(spark, speakers):
    train, lines = speakers
    docs = frame(spark, [lines["en"], None, "12", lines["ru"]])
    kept = langid.keep_identified(docs, train)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 3]


def test_texts_of_no_learned_language_go(spark):
    train = spark.read.parquet(f"{SF}/documents.parquet")
    short = [" ".join(r.text.split()[:6]) for r in train.where("doc_id < 40 and text rlike '^[A-Z][a-z]+ [a-z]+ [a-z]+ '").collect()]
    none = ["Быстрая лиса бежит через лес", "xqzv kjwq zzxk vvqj wxqz kkzq", "すばやい狐が森を走る", "你好世界", "ζωή και φως"]
    docs = frame(spark, none + short)
    kept = sorted(r.doc_id for r in langid.keep_identified(docs, train).collect())
    assert len(short) > 5 and kept == list(range(len(none), len(none) + len(short)))


def test_keeping_does_not_depend_on_how_many_languages_tie(spark):
    text = "clean short text"
    for n in (1, 4, 8):
        train = spark.createDataFrame([(i, text, f"l{i}", "s", 1, "x", 0) for i in range(n)], SCHEMA)
        assert [r.doc_id for r in langid.keep_identified(frame(spark, [text, "qzx wvk"]), train).collect()] == [0]


def test_scripts_narrow_the_languages(spark, speakers):
    train, lines = speakers
    train = train.unionByName(frame(spark, ["今天天气很好我们一起去公园散步"] * 10, "zh")).unionByName(
        frame(spark, ["きょうはてんきがいいのでこうえんをさんぽします"] * 10, "ja")
    )
    parts = [(lines["en"], "en"), ("лису", "ru"), (lines["de"], "de"), ("今天天气很好我们一起去公园散步", "zh"),
             ("きょうはてんきがいいのでこうえんをさんぽします", "ja"), (lines["en"], "en")]
    text = " ".join(p for p, _ in parts)
    joined = "今天天气很好我们一起去公园散步" + "きょうはてんきがいいのでこうえんをさんぽします"
    rows = {r.doc_id: r for r in langid.language_id(frame(spark, [text, joined]), train, spans=True).collect()}
    assert [(text[s.start : s.end], s.lang) for s in rows[0].spans] == parts
    assert {s.lang for s in rows[1].spans} == {"zh", "ja"} and rows[1].spans[-1].end == len(joined)


def test_long_runs_without_blanks_gain_by_their_length(spark):
    """Two languages of one script, and a run of each."""
    one, two = "天地玄黄宇宙洪荒日月盈昃", "寒来暑往秋收冬藏闰余成岁"
    train = spark.createDataFrame([(i, t, k, "s", 1, "x", 0) for i in range(10) for t, k in ((one, "a"), (two, "b"))], SCHEMA)
    text = one * 3 + "。" + two * 3
    (row,) = langid.language_id(frame(spark, [text]), train, spans=True).collect()
    assert [(text[s.start : s.end], s.lang) for s in row.spans] == [(one * 3, "a"), (two * 3, "b")]


# Helpers -----------------------------------------------------------------------


def test_numbered_rows_have_no_gap(spark):
    rows = spark.range(1000).select((F.col("id") * 37 % 100).alias("k"))
    got = numbered(rows, [F.col("k")], "n", partitions=7).collect()
    assert sorted(r.n for r in got) == list(range(1000))
    assert [r.k for r in sorted(got, key=lambda r: r.n)] == sorted(r.k for r in got)


def test_components_of_chains_and_stars(spark):
    edges = [(i + 1, i) for i in range(60)] + [(200 + i, 200) for i in range(1, 40)] + [(300, 5), (205, 204)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: 0 for n in [*range(61), 300]} | {n: 200 for n in range(200, 240)}


# Pipeline ----------------------------------------------------------------------


def test_pipeline_by_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    shared = "shared passage " * 30
    odd = spark.createDataFrame(
        [(1000, None, "en"), (1001, "", "en"), (1002, "12 34", "en"), (1003, "the and of " + shared, "en"),
         (1004, "to in is " + shared, None), (1005, "to in is " + shared, "en"), (1005, "to in is " + shared, "en")],
        "doc_id long, text string, lang string",
    ).withColumn("source", F.lit(None).cast("string")).withColumn("n_chars", F.lit(0).cast("long"))
    docs = docs.unionByName(odd)
    kept = docs
    frames = {}
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, SF)
        frames[name] = kept
        if name != "packing":
            assert kept.columns == docs.columns
    first = {r.doc_id for r in frames["language_id"].collect()}
    assert not first & {1000, 1001, 1002} and {1003, 1004, 1005} <= first
    exact_rows = frames["exact_dedup"].collect()
    assert len({r.text for r in exact_rows}) == len(exact_rows)
    assert {1005} == {r.doc_id for r in exact_rows if r.text.startswith("to in is")}
    near = {r.doc_id for r in frames["simhash_dedup"].collect()}
    cut = {r.doc_id: r.text for r in frames["repeat_removal"].collect()}
    assert set(cut) == near
    packed = frames["packing"].collect()
    assert {r.doc_id for r in packed} == near
    assert all(r.offset + r.length <= 4096 for r in packed)


def test_pipeline_of_nothing(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_no_python_on_the_native_path(spark):
    from lakebook.llm.queries import QUERIES

    plan = QUERIES["op1_quality_rules"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_nothing_else_imports_these_operators():
    root = Path(corpus_pipeline.__file__).parent
    others = [p for p in root.glob("lakebook/**/*.py") if "llm" not in p.relative_to(root).parts]
    assert others and not any("lakebook.llm" in p.read_text() for p in others)
