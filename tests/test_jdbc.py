"""Reader options only: these tests open no database."""

from __future__ import annotations

import pytest

from lakebook.sources.jdbc import read_snapshot, snapshot_options

URL = "jdbc:postgresql://example.org/shop"


def test_plain_snapshot():
    assert snapshot_options(URL, "sales", user="reader") == {
        "url": URL,
        "dbtable": "public.sales",
        "fetchsize": "10000",
        "user": "reader",
    }


def test_split_snapshot():
    options = snapshot_options(
        URL, "sales", split_on="id", bounds=(1, 9_000_000_000), partitions=64
    )
    assert options["partitionColumn"] == "id"
    assert (options["lowerBound"], options["upperBound"]) == ("1", "9000000000")
    assert options["numPartitions"] == "64"


def test_split_needs_bounds():
    with pytest.raises(ValueError):
        snapshot_options(URL, "sales", split_on="id")


class Recorder:
    """Stands in for ``spark.read`` and keeps what the source asks of it."""

    def __init__(self):
        self.calls = {}

    @property
    def read(self):
        return self

    def format(self, name):
        self.calls["format"] = name
        return self

    def options(self, **options):
        self.calls["options"] = options
        return self

    def load(self):
        return self.calls

    def jdbc(self, url, table, predicates, properties):
        return {"url": url, "table": table, "predicates": predicates, "properties": properties}


def test_whole_table_read():
    calls = read_snapshot(Recorder(), URL, "users", schema="shop", one_task=True, password="x")
    assert calls["format"] == "jdbc"
    assert calls["options"]["dbtable"] == "shop.users"
    assert calls["options"]["password"] == "x"


def test_read_by_text_keys():
    parts = ["id < 'm'", "id >= 'm' or id is null"]
    calls = read_snapshot(Recorder(), URL, "users", predicates=parts, user="reader")
    assert (calls["url"], calls["table"], calls["predicates"]) == (URL, "public.users", parts)
    assert calls["properties"] == {"fetchsize": "10000", "user": "reader"}


def test_one_way_of_splitting():
    with pytest.raises(ValueError):
        read_snapshot(
            Recorder(), URL, "users", predicates=["true"], split_on="id", bounds=(0, 1),
            partitions=2,
        )


def test_how_to_cut_a_table_must_be_said():
    with pytest.raises(ValueError):
        read_snapshot(Recorder(), URL, "users")


def test_an_upper_bound_for_the_run():
    options = snapshot_options(URL, "sales", until=("changed", "timestamp '2026-04-08 00:00:00'"))
    assert options["dbtable"] == (
        "(select * from public.sales where changed <= timestamp '2026-04-08 00:00:00') as sales"
    )
