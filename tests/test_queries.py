"""Every registered query against its SQL, at the smallest scale."""

from __future__ import annotations

import __spark_entry__ as registered
import pytest
from compare import connect, difference

SF = "/root/testdata/sf0.001"
SQL = registered.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


SERVICE = registered.oracles.oracle_sql()


def test_every_service_query_has_its_sql():
    names = {n for n in registered.queries() if not n.startswith("op") and n != "pipeline"}
    assert names == SERVICE.keys()


@pytest.mark.parametrize("name", [n for n in SERVICE if n != "j5_business_minutes_dim"])
def test_query(spark, duck, name):
    assert difference(registered.queries()[name](spark, SF), duck, SQL[name]) is None


def test_entry(spark):
    assert registered.entry(spark).count() == 9
