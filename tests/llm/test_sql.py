"""The training-data queries that SQL can express, against DuckDB on the sf0.01 tables."""

import pytest

from conftest import SF_CHECK
from livemart.llm.queries import LLM_ORACLE_SQL, LLM_QUERIES
from oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_CHECK)


@pytest.mark.parametrize("name", sorted(LLM_ORACLE_SQL))
def test_query_matches_sql(spark, con, name):
    line = compare(spark, con, name, LLM_QUERIES[name], LLM_ORACLE_SQL[name], SF_CHECK)
    assert line.startswith("OK"), line
