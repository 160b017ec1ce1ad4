"""Every registered query against its SQL in DuckDB, over whole tables."""

import pytest
from compare import compare, oracle

from flowspark import catalog


@pytest.fixture(scope="module")
def con(sf):
    return oracle(sf)


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query_agrees(spark, con, sf, name):
    assert compare(spark, con, sf, name) is None


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
