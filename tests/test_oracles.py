"""Every query against its SQL twin: names, types, all values."""

import pytest
from compare import connect, differences

import __spark_entry__ as contract

from oracles import load_oracles
from tillforge.plans.catalog import QUERIES

ORACLES = {name: sql for name, sql in load_oracles().items() if name in QUERIES}


@pytest.fixture(scope="module")
def con(base):
    return connect(base)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_twin(spark, con, base, name):
    assert differences(QUERIES[name](spark, base), con, ORACLES[name]) == []


def test_all_queries_have_a_twin():
    assert set(QUERIES) == set(ORACLES)


def test_entry_has_rows_and_a_stable_schema(spark):
    df = contract.entry(spark)
    assert df.columns[:2] == ["region", "store_name"] and df.count() > 0
