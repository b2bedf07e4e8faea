"""The text queries that SQL expresses, at the smallest scale."""

from __future__ import annotations

import __spark_entry__ as registered
import pytest
from compare import connect, difference

from waitline.llm import queries, sql

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sql.oracle_sql())
def test_query(spark, name):
    query = registered.queries()[name]
    assert difference(query(spark, SF), connect(SF), registered.oracle_sql()[name]) is None


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))
    assert "pipeline" in registered.queries()
