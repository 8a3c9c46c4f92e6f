"""Commits of the WARC sink, and odd pages."""

from __future__ import annotations

import io
import random
from collections import Counter

import pytest

from lakebook.llm import warc

KINDS = "page_id long, url string, html string"


def write(spark, path, rows, mode="append"):
    warc.register(spark)
    pages = spark.createDataFrame(rows, KINDS)
    warc.with_revisits(pages).write.format("warc").mode(mode).save(str(path))


def payloads(spark, path):
    rows = spark.read.format("warc").load(str(path)).select("record_id", "payload").collect()
    return Counter((r.record_id, bytes(r.payload)) for r in rows)


def record(i, text):
    return f"<urn:page:{i}>", text.encode()


def test_a_second_append_adds_to_the_first(spark, tmp_path):
    write(spark, tmp_path / "w", [(1, "u", "a"), (2, "u", "b")])
    write(spark, tmp_path / "w", [(3, "u", "c")])
    assert payloads(spark, tmp_path / "w") == Counter([record(1, "a"), record(2, "b"), record(3, "c")])
    write(spark, tmp_path / "w", [])
    assert payloads(spark, tmp_path / "w").total() == 3


def test_overwriting_leaves_the_last_write_only(spark, tmp_path):
    for text in "abc":
        write(spark, tmp_path / "w", [(1, "u", text)])
    write(spark, tmp_path / "w", [(9, "u", "z")], "overwrite")
    assert payloads(spark, tmp_path / "w") == Counter([record(9, "z")])
    assert len(list((tmp_path / "w").glob("part-*"))) == 1


def one_write(path, rows, overwrite=False):
    import pyarrow as pa

    writer = warc.WarcWriter({"path": str(path)}, overwrite)
    names = ["record_id", "record_type", "target_uri", "payload_digest", "refers_to", "payload_length", "payload"]
    batch = pa.RecordBatch.from_pylist(
        [dict(zip(names, (f"<urn:page:{i}>", "response", "u", "sha256:0", None, len(t), t.encode()), strict=True)) for i, t in rows]
    )
    return writer, writer.write(iter([batch]))


def test_a_repeated_commit_counts_once_and_lost_tasks_leave_nothing(spark, tmp_path):
    warc.register(spark)
    writer, done = one_write(tmp_path / "w", [(1, "a")])
    lost = writer.write(iter([]))
    stray = writer.write(iter(one_write(tmp_path / "other", [])[1:0]))
    assert lost.files == stray.files == ()
    (tmp_path / "w" / f"part-{writer.name}-0.warc.gz").write_bytes(b"half a task")
    for _ in range(2):
        writer.commit([done, None])
        assert payloads(spark, tmp_path / "w") == Counter([record(1, "a")])
    assert len(list((tmp_path / "w").glob("part-*"))) == 1


def test_an_aborted_write_is_gone(spark, tmp_path):
    write(spark, tmp_path / "w", [(1, "u", "a")])
    writer, done = one_write(tmp_path / "w", [(2, "b")])
    assert len(list((tmp_path / "w").glob("part-*"))) == 2
    writer.abort([done, None])
    assert payloads(spark, tmp_path / "w") == Counter([record(1, "a")])
    assert len(list((tmp_path / "w").glob("part-*"))) == 1


def test_members_too_long_to_note_are_inflated_past(monkeypatch):
    draw = random.Random(5)
    blocks = [bytes(draw.getrandbits(8) for _ in range(n)) for n in (50_000, 200, 50_000)]
    monkeypatch.setattr(warc, "LONGEST_NOTED", 10_000)
    data = b"".join(
        warc.gzip_member(warc.record_bytes({"WARC-Type": "response", "WARC-Record-ID": str(i)}, b), 1) for i, b in enumerate(blocks)
    )
    found = list(warc.records(io.BytesIO(data), lambda h: h["warc-record-id"] == "2", True))
    assert [(h["warc-record-id"], b) for _, h, b in found] == [("2", blocks[2])]


@pytest.mark.parametrize("ids", [["1", "x", "2.5", None], [1.0, 2.5, None, float("nan")]])
def test_ids_that_are_no_whole_numbers_come_back_null(spark, tmp_path, ids):
    kind = "string" if isinstance(ids[0], str) else "double"
    pages = spark.createDataFrame([(i, "u", f"text {n}") for n, i in enumerate(ids)], f"page_id {kind}, url string, html string")
    got = warc.archive_roundtrip(pages, str(tmp_path / "w")).collect()
    assert len(got) == len(ids)
    assert sorted((r.page_id for r in got), key=str) == sorted([1 if kind == "string" else None, *[None] * 3], key=str)


def test_clashing_columns_and_long_texts(spark, tmp_path):
    long = "é" * 1_500_000
    rows = [(1, "u", long, "x"), (2, "u", long, "x"), (2, "u", long, "x"), (3, "u", "short", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string")
    pages = pages.withColumns({name: pages.page_id for name in ("digest", "n", "id", "first_id", "record_type")})
    got = warc.archive_roundtrip(pages, str(tmp_path / "w")).collect()
    assert sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got) == [
        (1, 3_000_000, "response", None), (2, 3_000_000, "revisit", 1), (2, 3_000_000, "revisit", 1),
        (3, 5, "response", None),
    ]
