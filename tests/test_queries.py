"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry_points
from labmeter.catalog.oracles import ORACLES
from labmeter.catalog.queries import ALL
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
QUERIES = ALL
SQL = ORACLES


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, SQL[name]) == []


def test_entry_runs(spark):
    result = entry_points.entry(spark)
    assert result.count() > 0
    assert result.columns[:3] == ["vm_name", "owner", "lab"]
