"""Every registered query against its SQL, and the contract of the entry module."""

import pytest
from compare import connect, difference

import __spark_entry__ as contract
from tidemark.plans.oracle import all_oracles
from tidemark.plans.registry import MODEL_PLANS, PLANS, all_queries

DATA = "/root/testdata/sf0.001"
SQL = contract.oracle_sql()
NO_SQL = set(MODEL_PLANS)


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


def test_every_query_has_sql_or_a_reason():
    assert set(all_queries()) - set(all_oracles()) == NO_SQL
    assert set(SQL) <= set(contract.queries()) and set(all_queries()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["membership_tier", "customers", "churned", "churn_rate_pct", "avg_ltv_usd"]
    assert df.count() == 4


@pytest.mark.parametrize("name", sorted(set(PLANS) - NO_SQL))
def test_query_equals_sql(spark, con, name):
    assert difference(all_queries()[name](spark, DATA), con, SQL[name]) is None
