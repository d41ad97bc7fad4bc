"""Every query against its SQL, on the smallest tables."""

import os

import pytest
from oracle_check import compare, oracle

from adjudica.plans.registry import load_all

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = load_all()


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    ok, line = compare(spark, con, name, QUERIES[name], SF)
    assert ok, line


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert "replacement" not in entry.entry(spark).columns and entry.entry(spark).columns
