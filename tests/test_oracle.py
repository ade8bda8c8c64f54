"""Every registered query against its SQL oracle on the smallest data folder."""

import os

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, connection, name):
    if name in entry.oracle_sql():
        assert compare(spark, connection, FOLDER, name) is None
    else:
        assert entry.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
