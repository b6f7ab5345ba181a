"""Every registered query against its DuckDB text, on the smallest tables."""

import pytest

from checks import registry
from checks.compare import connect, differences

registry.load()


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_matches_duckdb(spark, sf, duck, name):
    found = differences(registry.QUERIES[name](spark, sf), duck.execute(registry.ORACLES[name]).df())
    assert found is None, found


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries
    assert entry(spark).count() == 200 * 8 * 12
    assert set(oracle_sql()) <= set(queries())
