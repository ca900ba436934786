"""Every registered query against its SQL counterpart."""

import pytest

from workload import registry
from workload.compare import connect, differences

QUERIES = registry.queries()
STATEMENTS = registry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_equals_sql(spark, small, con, name):
    df = QUERIES[name](spark, small)
    assert differences(df, con, STATEMENTS[name]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(STATEMENTS)))
def test_without_sql_gives_rows(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_every_statement_belongs_to_a_query():
    assert set(STATEMENTS) <= set(QUERIES)
