"""Every registered query on the smallest tables, beside its SQL in DuckDB."""

import os

import pytest

import __spark_entry__ as contract
from tests.compare import compare, connection

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return connection(FOLDER)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, con, name):
    sql = contract.oracle_sql().get(name)
    wrong, count, _ = compare(spark, con, FOLDER, contract.queries()[name], sql)
    assert wrong is None
    assert count >= 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_oracle_has_its_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
