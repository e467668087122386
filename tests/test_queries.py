import os

import pytest

import __spark_entry__ as contract
from corpuslink.plans import catalog
from tests.compare import differences, duck

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_of_the_catalog_has_sql():
    assert set(catalog.QUERIES) == set(catalog.SQL)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert differences(contract.queries()[name](spark, SF_DIR), con, contract.oracle_sql()[name]) is None
