"""Every registered query at the smallest scale, against its SQL twin where there is one."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import connect, difference

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert difference(spark, con, name, QUERIES[name], SQL.get(name), SF) == ""


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["user_id", "date", "dailymean", "acute", "chronic", "acwr", "zone"]
    assert set(SQL) <= set(QUERIES)
