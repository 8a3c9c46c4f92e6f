"""Operators against brute force, the tokenizer library, and exact round trips."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakebook.llm import bpe, exact, packing, quality, sharding, simhash, suffix
from lakebook.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, fp string, row int"
ODD = [
    None, "", " ", "\n\n", "a", "a b", "a b c", "A b C a B c", "the cat the cat the cat the cat",
    "x   y　\nz", "tab\tand\x0bmore\x0c \r\n end ", "<|endoftext|> a<|endoftext|>  b", "it's we'll  don't",
    "café café é", "\U0001f600 你好世界 12 345", "\x1c!\x1d a\x85b", "same text here", "same text here",
    "word " * 3000, "L" * 5000, "#*$%&|<> [] <|startoftext|>",
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", None if i % 3 == 0 else f"h{i % 2}", 1, "k", "f", 1) for i, t in enumerate(ODD)]
    rows += [(None, "same text here", None, None, None, None, None, None)] * 2
    rows += [(7, "A b C a B c", "en", "h1", 1, "k", "f", 1)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


# Quality -----------------------------------------------------------------------


def base_counts(text):
    text = text or ""
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(windows)
    covered = {i + j for i, x in enumerate(windows) if n[x] > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if words(line)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_quality_base_counts(odd):
    got = quality.quality_rules(odd).collect()
    assert Counter((r.doc_id, *(r[c] for c in quality.BASE)) for r in got) == Counter(
        (r.doc_id, *base_counts(r.text)) for r in odd.collect()
    )
    assert all(r.base_failed and not r.kept for r in got if r.n_words < 50)


def test_quality_line_limits(spark):
    own = "\n".join(" ".join(f"w{i}x{j}" for j in range(12)) for i in range(6))
    common = "\n".join(" ".join(f"c{i}x{j}" for j in range(12)) for i in range(10))
    rows = [(i, own.replace("w", f"w{i}") + ("\n" + common if i < 30 else ""), "big") for i in range(60)]
    rows += [(100 + i, own.replace("w", f"v{i}") + "\n" + common, "small") for i in range(5)]
    got = {r.doc_id: r for r in quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string"), keep_text=True).collect()}
    assert all(not got[i].kept and got[i].n_removed_lines == 10 for i in range(30))
    assert all(got[i].kept and got[i].n_removed_lines == 0 for i in [*range(30, 60), *range(100, 105)])
    assert got[0].clean_text == rows[0][1].split("\n" + common)[0]


def test_lines_of_fixed_spread_go_on_a_host_of_any_size(spark):
    """1,001 of 120,000 documents are under a hundredth; 1,000 are not enough."""
    n = F.col("doc_id")
    own = F.concat(F.lit("own "), n.cast("string"))
    text = F.when(n < 1001, F.concat(own, F.lit("\nshared by many"))).when(n < 2001, F.concat(own, F.lit("\nshared by fewer"))).otherwise(own)
    rows = spark.range(120_000).withColumnRenamed("id", "doc_id").select("doc_id", text.alias("text"), F.lit("hot").alias("source"))
    found = quality.frequent_lines(rows).collect()
    assert [(r.host, r.n_docs) for r in found] == [("hot", 1001)]
    lost = quality.quality_rules(rows.where(n < 2001), min_docs=1, share=1.0, enough_docs=1000).where("n_removed_lines = 1")
    assert sorted(r.doc_id for r in lost.collect()) == list(range(1001))


# Sharding ----------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000, 4097])
def test_feistel_is_a_permutation(n):
    assert sorted(sharding.permute(np.arange(n), n)) == list(range(n))


def test_shards(documents):
    rows = sharding.assign_shards(documents.select("doc_id"), [F.col("doc_id")], 8).collect()
    ids = sorted(r.doc_id for r in documents.collect())
    places = sharding.permute(np.arange(len(ids)), len(ids))
    assert {r.doc_id: (r.shard, r.slot) for r in rows} == {d: (p % 8, p // 8) for d, p in zip(ids, places, strict=True)}
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))


def test_written_shards_hold_every_row_in_order(spark, documents, tmp_path):
    sharding.write_shards(documents.select("doc_id", "text"), [F.col("doc_id")], 4, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == documents.count()
    for shard in range(4):
        slots = [r.slot for r in spark.read.parquet(str(tmp_path / f"s/shard={shard}")).coalesce(1).collect()]
        assert sorted(slots) == list(range(len(slots)))


def test_sharding_query_sizes(spark):
    rows = QUERIES["op3_sharding"](spark, SF).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert all(r.size == len(texts[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id]) for r in rows)


# Exact dedup -------------------------------------------------------------------


@pytest.mark.parametrize("max_bits", [1 << 18, 1 << 28])
def test_exact_report(odd, max_bits):
    rows = odd.collect()
    groups = defaultdict(list)
    for r in rows:
        groups[r.text or ""].append(r.doc_id)
    got = exact.duplicate_report(odd, max_bits=max_bits).collect()
    assert len(got) == len(rows)
    for text, ids in groups.items():
        own = [r for r in got if r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()]
        known = [i for i in ids if i is not None]
        assert len(own) == len(ids) and {r.group_size for r in own} == {len(ids)}
        assert {r.keep_id for r in own} == {max(known) if known else None}
        assert sum(r.kept for r in own) == 1


@pytest.fixture(scope="module")
def awkward(odd):
    """Columns that no plain reference reaches, that cannot be ordered, or that clash."""
    return odd.withColumns(
        {"a.b": F.lit(1), "tick`s": F.lit(2), "m": F.create_map(F.lit("k"), F.lit(1)), "sha": F.lit("x"), "root": F.lit(3)}
    )


def test_awkward_columns_come_through(awkward):
    kept = exact.drop_duplicates(awkward)
    assert kept.columns == awkward.columns and kept.count() == len({r.text or "" for r in awkward.collect()})
    near = simhash.drop_near_duplicates(awkward)
    assert near.columns == awkward.columns and near.count() > 0
    cut = suffix.without_repeats(awkward)
    assert cut.columns == awkward.columns and cut.count() == awkward.count()


def test_exact_drop_keeps_columns(odd):
    kept = exact.drop_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r.text or "" for r in kept.collect()) == sorted({r.text or "" for r in odd.collect()})


def test_bloom_marks_cover_full_filter(spark):
    """With as few bits as rows, everything is suspect and the result is the same."""
    frame = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 1000).cast("string").alias("text"))
    got = exact.duplicate_report(frame).collect()
    assert all(r.group_size == 3 and r.keep_id == 2000 + r.doc_id % 1000 for r in got)


# SimHash -----------------------------------------------------------------------


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(lowered)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, radius=3):
    """(smallest id reachable) of each (id, fingerprint) by comparing all pairs."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= radius:
                parent[find(i)] = find(j)
    best = defaultdict(list)
    for i, (doc_id, _) in enumerate(prints):
        best[find(i)].append(doc_id)
    return [min((d for d in best[find(i)] if d is not None), default=None) for i in range(len(prints))]


def test_simhash_against_all_pairs(odd, documents):
    frame = documents.select("doc_id", "text").unionByName(odd.select((F.col("doc_id") + 10_000).alias("doc_id"), "text"))
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in frame.collect()]
    expected = Counter((d, f"{f:016x}", c) for (d, f), c in zip(rows, components(rows), strict=True))
    assert Counter(tuple(r) for r in simhash.near_duplicates(frame).collect()) == expected


@pytest.mark.parametrize("shard", [4, 1024])
def test_near_links_join_all_pairs(spark, shard):
    """Clusters around centres, some denser than a shard, and chains of near values."""
    draw = random.Random(5)
    values = set()
    for _ in range(6):
        centre = draw.getrandbits(64)
        for _ in range(40):
            value = centre
            for _ in range(draw.randrange(5)):
                value ^= 1 << draw.randrange(64)
            values.add(value)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), shard=shard).collect()
    parent = {v: v for (v,) in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    mask = (1 << 64) - 1
    for a, b in links:
        parent[find(a)] = find(b)
    expected = components([(v, v & mask) for (v,) in signed])
    for i, (a,) in enumerate(signed):
        for j in range(i):
            assert (find(a) == find(signed[j][0])) == (expected[i] == expected[j])


def test_simhash_drop(odd):
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in odd.collect()]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(components(rows)))


# BPE ---------------------------------------------------------------------------


def library(path, texts):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer, [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("size", [3, 300_000])
def test_bpe_equals_library(odd, documents, size):
    frame = odd.select("doc_id", "text").unionByName(documents.select((F.col("doc_id") + 100).alias("doc_id"), "text"))
    got = bpe.roundtrip(frame, size=size).withColumn("a", bpe.as_array(F.col("ids"))).collect()
    texts = [r.text for r in frame.collect()]
    tokenizer, ids = library(bpe.BYTE_BPE, texts)
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in got] == ids
    assert [r.a for r in got] == ids
    assert [r.decoded for r in got] == [tokenizer.decode(i, skip_special_tokens=False) for i in ids]


def test_words_join_to_the_text():
    for text in ODD:
        data = (text or "").encode()
        assert b"".join(bpe.split_words(data)) == data


# Packing -----------------------------------------------------------------------


def test_pieces_equal_library_and_sequences_are_whole(odd):
    frame = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = packing.pack_documents(frame, with_ids=True, capacity=256).collect()
    texts = {r.doc_id: r.text for r in frame.collect()}
    _, ids = library(packing.WORD_BPE, texts.values())
    for doc_id, own in zip(texts, ids, strict=True):
        pieces = sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.piece)
        joined = [i for r in pieces for i in np.frombuffer(r.ids, "<u4").tolist()]
        assert joined == [*own, 1]
        assert [r.start for r in pieces] == [256 * k for k in range(len(pieces))]
        assert all(r.length == 256 for r in pieces[:-1]) and all(r.ids_crc32 == zlib.crc32(r.ids) for r in pieces)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256


@pytest.mark.parametrize("seed", range(6))
def test_plan_packs_every_piece_once_and_tightly(seed):
    draw = random.Random(seed)
    histogram = Counter(min(512, max(1, int(draw.lognormvariate(4.5, 1)))) for _ in range(4000 * (seed + 1)))
    planned = packing.plan(dict(histogram), 512, 8)
    seen = Counter()
    for lengths, repeats in planned:
        assert sum(lengths) <= 512 and repeats > 0
        for length in lengths:
            seen[length] += repeats
    assert seen == histogram
    assert sum(n for _, n in planned) <= 1.02 * sum(k * n for k, n in histogram.items()) / 512 + 2
    assert packing.fit(dict(histogram), 512, 8), "the patterns take part"


def test_least_squares_is_optimal():
    """No column can lower the error: slopes are 0 where x > 0 and not positive elsewhere."""
    draw = np.random.default_rng(1)
    a, b = draw.integers(0, 3, (12, 40)).astype(float), draw.random(12) * 9
    x = packing.nnls(a, b)
    slope = a.T @ (b - a @ x)
    assert (x >= 0).all() and np.allclose(slope[x > 0], 0, atol=1e-6) and (slope <= 1e-6).all()


# All ---------------------------------------------------------------------------


def test_empty_tables(empty):
    assert quality.quality_rules(empty).count() == 0
    assert sharding.assign_shards(empty, [F.col("doc_id")], 8).count() == 0
    assert exact.duplicate_report(empty).count() == 0
    assert exact.drop_duplicates(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.drop_near_duplicates(empty).count() == 0
    assert bpe.roundtrip(empty).count() == 0
    assert packing.pack_documents(empty).count() == 0
