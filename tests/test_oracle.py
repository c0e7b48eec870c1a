"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle import compare, connect

from rollcall.plans import ORACLE, QUERIES, load_all

load_all()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    problem = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    # Both sides may find nothing in tables this small.
    assert problem in (None, "EMPTY")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_runs(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.count() > 0
    assert len(set(df.columns)) == len(df.columns)
