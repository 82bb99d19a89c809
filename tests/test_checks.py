"""Every registered query of the core library against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from checks.compare import difference
from checks.oracle import ORACLES
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, name):
    assert name in ORACLES
    assert difference(spark, FOLDER, name) is None


def test_contract_holds_the_core_queries():
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLES.items() <= contract.oracle_sql().items()


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "activity_category" in df.columns
