"""Queries of these operators beside their SQL."""

import pytest

from tidemark.llm.queries import ORACLE, QUERIES
from workload.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_its_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE[name]) == []
