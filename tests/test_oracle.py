"""Every registered query against its SQL, at the smallest scale."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import check, database
from tidemark.catalog import ORACLES as SQL
from tidemark.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    assert check(spark, con, FOLDER, name, QUERIES[name], SQL.get(name)) is None


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries()) and set(QUERIES) <= set(queries())


def test_flagship_has_rows(spark):
    assert entry(spark).count() > 0
