"""Every registered query against its SQL on the smallest data."""

import pytest
from compare import compare, duck

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_entry(spark):
    assert entry.entry(spark).columns[:2] == ["race_id", "horse_id"]


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, sf, name):
    ok, note = compare(spark, con, sf, name, QUERIES[name], ORACLES[name])
    assert ok, note
