"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from oracle import connect, duck_rows, plain, spark_rows

import __spark_entry__ as entry_points
from lakebook.oracles import ORACLES
from lakebook.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(set(entry_points.queries()) & set(entry_points.oracle_sql())))
def test_query_matches_sql(spark, duck, name):
    names, types, rows = spark_rows(entry_points.queries()[name](spark, SF_DIR))
    duck_names, duck_types, duck_result = duck_rows(duck, entry_points.oracle_sql()[name])
    assert names == duck_names
    assert types == duck_types
    assert plain(rows) == plain(duck_result)
    assert sum(rows.values()) > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
