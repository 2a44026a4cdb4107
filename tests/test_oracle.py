"""Every registered query against its SQL. ``TEST_SF`` picks the scale."""

import os

import pytest

import __spark_entry__ as contract
from tests.compare import connect, differences

SF_DIR = f"/root/testdata/sf{os.environ.get('TEST_SF', '0.001')}"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_equals_sql(spark, connection, name):
    assert differences(spark, connection, SF_DIR, name) is None


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_runs(spark):
    result = contract.entry(spark)
    assert len(result.columns) == 48
    assert result.limit(1).count() == 1
