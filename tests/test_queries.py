"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tests.check import compare, connect
from tidefetch.plans.oracles import ORACLES
from tidefetch.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    problem, rows = compare(spark, con, FOLDER, QUERIES[name], ORACLES[name])
    assert not problem
    assert rows > 0


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns[:3] == ["partition_id", "slot", "name"]
    assert frame.count() == 200
