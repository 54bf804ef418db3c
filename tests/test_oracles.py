"""Every registered query against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    fn = entry.queries()[name]
    if name not in ORACLES:
        assert fn(spark, SF).count() > 0
        return
    result = compare(spark, con, fn, ORACLES[name], SF)
    assert result["equal"], result


def test_entry(spark):
    assert entry.entry(spark).count() == 200
