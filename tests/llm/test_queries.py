"""Registered corpus queries with SQL, on the smallest tables; test_operators has brute force for the others."""

from __future__ import annotations

import pytest

from tests.check import compare, connect
from tidefetch.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, name):
    problem, rows = compare(spark, connect(FOLDER), FOLDER, QUERIES[name], ORACLES[name])
    assert not problem
    assert rows > 0
