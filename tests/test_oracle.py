"""Every registered query that SQL can express against its DuckDB oracle."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_compare import compare, duck
from sessionlens.plans.catalog import QUERIES

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    problems, n = compare(df, con, E.oracle_sql()[name])
    assert not problems, problems
    assert n > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 83
    assert df.count() > 0
