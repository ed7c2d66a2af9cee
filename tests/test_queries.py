"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import pytest
from oracle import connect, difference

import __spark_entry__ as entry

from quillcast.plans import catalog

QUERIES = catalog.QUERIES
ORACLES = catalog.ORACLES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry.queries().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, sf_dir, name):
    ours = QUERIES[name](spark, sf_dir).toPandas()
    assert len(ours) > 0
    assert difference(ours, con.sql(ORACLES[name]).df()) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["window_start", "rt_id", "screen_name", "text", "cnt"]
