import os

import oracle
import pytest

import __spark_entry__ as contract
from daystrata.queries import all_queries, all_sql

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.connection(SF_DIR)


@pytest.mark.parametrize("name", all_queries())
def test_query_equals_its_sql(spark, con, name):
    frame = contract.queries()[name](spark, SF_DIR)
    assert oracle.compare(frame, contract.oracle_sql()[name], con) > 0


def test_entry(spark):
    assert contract.entry(spark).columns == ["ObservationDate", "Region", "ScreenTemperature"]


def test_every_query_has_sql():
    assert all_queries().keys() == all_sql().keys()
    assert all_queries().keys() <= contract.queries().keys()
