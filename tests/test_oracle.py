"""Every registered query against its SQL oracle (DuckDB) on the sf0.01 tables."""

import pytest

from conftest import SF_CHECK
from oracle_compare import compare, duck

from __spark_entry__ import oracle_sql, queries
from livemart.plans.catalog import QUERIES
from livemart.plans.streams import STREAM_QUERIES

# the training-data operators have no SQL; tests/llm holds them against brute force
NAMES = sorted({**QUERIES, **STREAM_QUERIES})


@pytest.fixture(scope="module")
def con():
    return duck(SF_CHECK)


def test_every_query_has_an_oracle():
    missing = set(NAMES) - set(oracle_sql())
    assert not missing, missing


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    line = compare(spark, con, name, queries()[name], oracle_sql().get(name), SF_CHECK)
    assert line.startswith("OK"), line


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["logdate", "hour", "today", "yesterday"]
    assert df.count() > 0
