"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as entry
from strata.oracle import oracle_sql
from strata.registry import QUERIES
from strata.session import scratch_scope
from tests.conftest import SF_SMALL
from tools.compare import compare_one, duck

ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    with scratch_scope(spark):
        res = compare_one(spark, con, name, SF_SMALL, QUERIES, ORACLE)
    assert res["status"] == "ok", res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 414
