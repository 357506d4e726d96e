"""Every named query against the same query in SQL, over whole tables."""

from __future__ import annotations

import importlib.util
import os

import pytest
from conftest import SMALL
from oracle_check import compare, connect

from servery.plans.queries import QUERIES

spec = importlib.util.spec_from_file_location(
    "spark_entry", os.path.join(os.path.dirname(__file__), "..", "__spark_entry__.py")
)
contract = importlib.util.module_from_spec(spec)
spec.loader.exec_module(contract)


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = contract.queries()[name](spark, SMALL)
    assert compare(result, duck, contract.oracle_sql()[name]) > 0


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 10
    revenues = [row["total_revenue"] for row in rows]
    assert revenues == sorted(revenues, reverse=True)
