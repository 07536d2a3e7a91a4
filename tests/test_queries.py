"""Every registered query against its SQL on the smallest tables; the entry contract."""

import os

import pytest

import __spark_entry__ as contract
from tests.oracle import compare, connect

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
# Models need the documents of the larger scale to learn from.
ON_MEDIUM = ("t2_", "t3_", "t4_", "t5_", "t6_")

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


@pytest.fixture(scope="module")
def connections():
    return {folder: connect(folder) for folder in (SMALL, MEDIUM)}


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, connections, name):
    folder = MEDIUM if name.startswith(ON_MEDIUM) else SMALL
    df = contract.queries()[name](spark, folder)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, connections[folder], sql) == []


def test_entry(spark):
    assert contract.entry(spark).count() == 4


def test_sql_only_for_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())
