"""Every registered query against its SQL twin, and the driver contract."""

import os

import pytest

import __spark_entry__ as contract
from compare import compare, duck
from millrace.catalogue import CATALOGUE

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(DATA)


@pytest.mark.parametrize("name", sorted(CATALOGUE))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, name, CATALOGUE[name], con, DATA) is None


def test_entry_gives_seven_checks(spark):
    rows = contract.entry(spark).collect()
    assert [r.check_name for r in rows] == [
        "NON_NULL",
        "NUM_RANGE",
        "SCHEMA",
        "GEO_BOUNDS",
        "check_openaq_nulls",
        "check_openaq_freshness",
        "check_openaq_who_threshold",
    ]
    assert [r.status for r in rows] == ["FAIL", "FAIL", "PASS", "FAIL", "PASS", "PASS", "FAIL"]


def test_contract_names():
    queries, twins = contract.queries(), contract.oracle_sql()
    assert set(twins) <= set(queries)
    assert set(CATALOGUE) <= set(twins)
