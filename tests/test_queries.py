"""Every registered query against its SQL on the driver's tables, where they are at hand."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from ebbflow.plans.registry import ORACLES, QUERIES
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert slow not in plan
    _, problems = compare(duck, df, entry.oracle_sql()[name])
    assert not problems


def test_entry_is_sorted_as_asked(spark):
    rows = entry.entry(spark).collect()
    prices = [r["price"] for r in rows]
    assert prices and prices == sorted(prices, reverse=True)
