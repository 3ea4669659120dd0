"""Every registered query against its SQL, at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from oracle_check import compare, connect
from tapeloom.plans import catalog

SF = driver.SMOKE_DIR


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() == 1000
    assert len(df.columns) == 11


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(driver.queries()) >= set(driver.oracle_sql()) >= set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, SF) is None
