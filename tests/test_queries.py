"""Every registered query against its SQL on the smallest data, and the shape of the driver contract."""

import pytest

import __spark_entry__ as entry
from tests import oracle
from tidemark.catalog import ORACLES, QUERIES

FOLDER = oracle.folder("sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_agrees_with_sql(spark, con, name):
    result = QUERIES[name](spark, FOLDER).toArrow()
    assert oracle.compare(name, result, oracle.fetch(con, ORACLES[name])) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_compare_notices_differences(con):
    one = oracle.fetch(con, "SELECT 1 AS a, 2.0::DOUBLE AS b")
    assert oracle.compare("x", one, oracle.fetch(con, "SELECT 1 AS a, 2.0::DOUBLE AS b")) == []
    for other in (
        "SELECT 1 AS a, 2.5::DOUBLE AS b",
        "SELECT 1::BIGINT AS a, 2.0::DOUBLE AS b",
        "SELECT 1 AS a",
        "SELECT 1 AS a, NULL::DOUBLE AS b",
        "SELECT 1 AS a, 2.0::DOUBLE AS b UNION ALL SELECT 1, 2.0",
    ):
        assert oracle.compare("x", one, oracle.fetch(con, other))
