"""Every registered query next to its SQL oracle, on whole tables."""

import os

import pytest
from compare import connect, differences

import __spark_entry__ as registered
from checks.oracle import ORACLE
from checks.queries import REGISTRY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(ORACLE)


@pytest.mark.parametrize("key", list(REGISTRY))
def test_matches_oracle(spark, con, key):
    df = registered.queries()[key](spark, SF_DIR)
    assert differences(df, con, registered.oracle_sql()[key]) == []


def test_entry_runs(spark):
    assert registered.entry(spark).columns == ["variable", "date", "zone_id", "value"]
