"""Every registered query against its SQL, on the smallest of the given data sets."""

from __future__ import annotations

import pytest

import __spark_entry__
from postura.workload.registry import ENTRIES
from tests.compare import connect, difference, oracle_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"
SQL = __spark_entry__.oracle_sql()
NAMES = sorted(ENTRIES)


@pytest.fixture(scope="module")
def con():
    with connect(SF_DIR) as c:
        yield c


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    df = __spark_entry__.queries()[name](spark, SF_DIR)
    assert difference(spark_rows(df), oracle_rows(con, SQL[name])) is None


def test_every_query_has_sql():
    assert set(NAMES) <= set(SQL)


def test_entry(spark):
    found = __spark_entry__.entry(spark)
    assert found.columns == ["category", "red", "amber", "green"]
    assert found.count() == 4
