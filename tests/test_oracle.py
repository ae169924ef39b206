"""Every registered query that has SQL gives the rows DuckDB gives for it."""

import pytest
from tools.compare import compare, connect

from uptide.plans.catalog import QUERIES, SQL


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, sf, name):
    assert compare(QUERIES[name](spark, sf), duck, SQL[name]) == ""


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
