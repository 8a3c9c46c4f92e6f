"""Tables and values on the way end with their block; the result does not need them."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakebook.llm.phrases import collocations
from lakebook.llm.shared import Scratch, shared_value, stored
from lakebook.llm.suffix import without_repeats

SF = "/root/testdata/sf0.001"


@pytest.fixture
def apart(spark, tmp_path):
    session = spark.newSession()
    session.conf.set("lakebook.scratch.dir", str(tmp_path))
    return session


def tables(path):
    return sorted(name.rsplit("-", 1)[0] for root in path.iterdir() for name in os.listdir(root))


def test_a_block_removes_what_it_stored(apart, tmp_path):
    with Scratch(apart):
        outer = stored(apart.range(3), "outer")
        with Scratch(apart) as inner:
            value = shared_value(apart, [1, 2])
            gone = stored(apart.range(4), "gone")
            kept = stored(gone.where("id > 1"), "kept", outlive=True)
            assert tables(tmp_path) == ["gone", "kept", "outer"]
            assert inner.values == [value]
        assert tables(tmp_path) == ["kept", "outer"]
        assert kept.count() == 2 and outer.count() == 3
        result = stored(kept, "result", outlive=True)
    assert tables(tmp_path) == ["result"]
    assert result.count() == 2
    with pytest.raises(Exception, match="does not exist|FileNotFound|not exist"):
        gone.count()


def test_a_block_that_fails_cleans_up(apart, tmp_path):
    with pytest.raises(ZeroDivisionError), Scratch(apart):
        stored(apart.range(3), "gone")
        raise ZeroDivisionError
    assert tables(tmp_path) == []
    stored(apart.range(1), "free")
    assert tables(tmp_path) == ["free"]


def test_operators_leave_only_what_their_result_reads(apart, tmp_path):
    documents = apart.read.parquet(f"{SF}/documents.parquet")
    assert without_repeats(documents).count() == documents.count()
    assert tables(tmp_path) == ["spans"]
    assert collocations(documents).count() > 0
    assert tables(tmp_path) == ["collocations", "spans"]


def test_the_pipeline_leaves_its_result(apart, tmp_path):
    found = corpus_pipeline.run(apart, SF)
    assert tables(tmp_path) == ["sequences"]
    assert found.agg(F.sum("length")).first()[0] > 0
