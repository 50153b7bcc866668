"""Every registered query against its SQL, and the driver contract."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_module
from compare import assert_same, connect
from retailflow.tables.catalog import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = connect(FOLDER)
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_module.queries()) & set(entry_module.oracle_sql())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry_has_rows(spark):
    result = entry_module.entry(spark)
    assert result.columns == [
        "stt", "edt", "provinceId", "provinceName", "orderCount", "orderAmount",
    ]
    assert result.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    rows = entry_module.queries()[name](spark, FOLDER).toPandas()
    assert_same(rows, duck.execute(entry_module.oracle_sql()[name]).df(), name)
