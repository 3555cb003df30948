"""Every registered query against its SQL on another engine."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from firmscope.plans import catalog
from tests.compare import difference

DATA = "/root/testdata/sf0.001"
SQL = driver.oracle_sql()


def test_every_query_has_sql():
    assert set(catalog.QUERIES) <= set(SQL) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", catalog.QUERIES)
def test_query(spark, name):
    assert difference(spark, driver.queries()[name], SQL[name], DATA) is None
