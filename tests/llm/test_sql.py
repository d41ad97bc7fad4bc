"""Queries with SQL against DuckDB."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", ["op4_url_filter", "op10_decontamination", "op12_filter_audit", "op13_ranked_search"])
def test_query_equals_sql(llm, name):
    from oracle_check import compare, oracle

    from adjudica.llm.queries import QUERIES

    ok, line = compare(llm, oracle(SF_DIR), name, QUERIES[name], SF_DIR)
    assert ok, line
